"""Sales figures over the flat sales table and over revenue lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.functions.dates import parse_us_date
from shelfmark.functions.money import average, money_ratio, ratio, total
from shelfmark.operators.ordering import number_from_group_start, number_rows
from shelfmark.plans.facts import month_spine

def _sum(column: str) -> Column:
    return total(F.col(column))


# Flat table ------------------------------------------------------------------------------------

def region_revenue(flat: DataFrame, region: str) -> DataFrame:
    """Lines and revenue of one region."""
    return flat.filter(F.col("region") == region).groupBy("region").agg(
        F.count("*").alias("orders"), _sum("sales").alias("revenue"))


def top_expensive_lines(flat: DataFrame, category: str, minimum: float, k: int = 10) -> DataFrame:
    """The k dearest lines of a category above a minimum."""
    return (
        flat.filter((F.col("category") == category) & (F.col("sales") > minimum))
        .select("row_id", "product_name", "sales", "discount", F.round("profit", 2).alias("profit"))
        .orderBy(F.col("sales").desc(), "row_id").limit(k)
    )


def high_discount_lines(flat: DataFrame, discount: float) -> DataFrame:
    """Lines at or above a discount, worst profit first."""
    return flat.filter(F.col("discount") >= discount).select(
        "row_id", "product_name", "sales", "discount", F.round("profit", 2).alias("profit"),
    ).orderBy("profit", "row_id")


def region_performance(flat: DataFrame) -> DataFrame:
    return flat.groupBy("region").agg(
        F.count("*").alias("orders"), _sum("sales").alias("revenue"), _sum("profit").alias("profit"),
        average(F.col("sales")).alias("avg_order_value"),
    ).orderBy(F.col("revenue").desc(), "region")


def category_performance(flat: DataFrame) -> DataFrame:
    return flat.groupBy("category").agg(
        _sum("sales").alias("revenue"), F.sum("quantity").alias("quantity_sold"),
        average(F.col("profit")).alias("avg_profit"),
    ).orderBy(F.col("revenue").desc(), "category")


def segment_performance(flat: DataFrame) -> DataFrame:
    return flat.groupBy("segment").agg(
        _sum("sales").alias("revenue"), _sum("profit").alias("profit"),
    ).orderBy(F.col("revenue").desc(), "segment")


def top_products(flat: DataFrame, k: int = 10) -> DataFrame:
    return flat.groupBy("product_name").agg(
        _sum("sales").alias("revenue"), F.sum("quantity").alias("quantity"),
    ).orderBy(F.col("revenue").desc(), "product_name").limit(k)


def top_customers(flat: DataFrame, k: int = 10) -> DataFrame:
    return flat.groupBy("customer_name").agg(
        F.count_distinct("order_id").alias("orders"), _sum("sales").alias("revenue"), _sum("profit").alias("profit"),
    ).orderBy(F.col("revenue").desc(), "customer_name").limit(k)


def bottom_products(flat: DataFrame, k: int = 10) -> DataFrame:
    """The k products with the lowest profit."""
    return flat.groupBy("product_name").agg(_sum("profit").alias("total_loss")).orderBy(
        "total_loss", "product_name").limit(k)


def yearly_growth(flat: DataFrame) -> DataFrame:
    year = F.year(parse_us_date(F.col("order_date"))).alias("year")
    return flat.groupBy(year).agg(
        _sum("sales").alias("revenue"), _sum("profit").alias("profit"), F.count_distinct("order_id").alias("orders"),
    ).orderBy("year")


def monthly_sales(flat: DataFrame) -> DataFrame:
    day = parse_us_date(F.col("order_date"))
    return flat.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(
        _sum("sales").alias("monthly_sales")).orderBy("year", "month")


def loss_subcategories(flat: DataFrame) -> DataFrame:
    """Loss-making lines per sub-category, largest loss first."""
    return flat.filter(F.col("profit") < 0).groupBy("category", "sub_category").agg(
        F.count("*").alias("loss_rows"), _sum("profit").alias("total_loss"),
    ).orderBy("total_loss", "category", "sub_category")


# Revenue lines ---------------------------------------------------------------------------------
# `rev` is `revenue_lines(order_lines(...))`. Product attributes join after the sum per product, so
# that join moves one row per product.

def _per_product(rev: DataFrame, *measures: Column) -> DataFrame:
    return rev.groupBy("product_id").agg(*measures)


def revenue_by_category(rev: DataFrame, products: DataFrame) -> DataFrame:
    """Net revenue per category, highest first."""
    sums = _per_product(rev, F.sum("net_revenue").alias("_net"))
    return sums.join(products.select("product_id", "category"), "product_id").groupBy("category").agg(
        F.round(F.sum("_net"), 2).alias("net_revenue")).orderBy(F.col("net_revenue").desc(), "category")


def _units(returned: bool) -> Column:
    quantity = F.col("quantity")
    counted = F.when(quantity < 0, -quantity) if returned else F.when(quantity > 0, quantity)
    return F.sum(counted.otherwise(0))


def returns_exceed_purchases(rev: DataFrame, products: DataFrame) -> DataFrame:
    """Products with more units returned than bought."""
    units = _per_product(rev, _units(True).alias("returned_units"), _units(False).alias("purchased_units"))
    more = units.filter(F.col("returned_units") > F.col("purchased_units"))
    return more.join(products.select("product_id", "product_name", "category"), "product_id").select(
        "product_id", "product_name", "category", "returned_units", "purchased_units",
    ).orderBy(F.col("returned_units").desc(), "product_id")


def return_rate(rev: DataFrame, products: DataFrame) -> DataFrame:
    """Share of returned units per category."""
    units = _per_product(rev, _units(True).alias("_returned"), F.sum(F.abs("quantity")).alias("_moved"))
    return units.join(products.select("product_id", "category"), "product_id").groupBy("category").agg(
        ratio(F.sum("_returned"), F.sum("_moved"), 4).alias("return_rate"),
    ).orderBy(F.col("return_rate").desc(), "category")


def top_revenue_customers(rev: DataFrame, k: int = 10) -> DataFrame:
    return rev.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        _sum("net_revenue").alias("net_revenue")).orderBy(F.col("net_revenue").desc(), "customer_id").limit(k)


def _monthly(rev: DataFrame) -> DataFrame:
    """Revenue per month: as many rows as the calendar has months."""
    return rev.groupBy(F.col("order_month").alias("ym")).agg(F.sum("net_revenue").alias("revenue"))


def last_months(rev: DataFrame, k: int = 12) -> DataFrame:
    """Revenue of the last k months with data."""
    return _monthly(rev).select("ym", F.round("revenue", 2).alias("net_revenue")).orderBy(F.col("ym").desc()).limit(k)


def running_revenue(rev: DataFrame) -> DataFrame:
    """Daily and running revenue per region. The window runs over region-days, so its largest
    partition is one region's calendar."""
    daily = rev.groupBy("region_code", "order_day").agg(F.sum("net_revenue").alias("_net"))
    so_far = W.partitionBy("region_code").orderBy("order_day").rowsBetween(W.unboundedPreceding, W.currentRow)
    return daily.select(
        "region_code", "order_day", F.round("_net", 2).alias("daily_revenue"),
        F.round(F.sum("_net").over(so_far), 2).alias("running_revenue"),
    )


def product_rank(rev: DataFrame, products: DataFrame) -> DataFrame:
    """Products ranked by revenue inside their category. The product id breaks ties, so the dense
    rank is a row number; it is counted across range slices because one category may hold a large
    share of the products."""
    sums = _per_product(rev, F.sum("net_revenue").alias("_net"))
    named = sums.join(products.select("product_id", "product_name", "category"), "product_id")
    order = [F.col("category").asc(), F.col("_net").desc(), F.col("product_id").asc()]
    ranked = number_from_group_start(number_rows(named, order), ["category"], "revenue_rank")
    return ranked.select(
        "category", "product_id", "product_name", F.round("_net", 2).alias("total_revenue"), "revenue_rank")


def yoy_growth(rev: DataFrame, dense: bool = False) -> DataFrame:
    """Revenue per month against twelve rows earlier. With `dense`, months without revenue get a row
    with zero, so that twelve rows are always twelve months."""
    months = _monthly(rev)
    if dense:
        months = month_spine(months).join(months, "ym", "left").na.fill({"revenue": 0})
    # At most one row per calendar month reaches this window.
    prior = F.lag("revenue", 12).over(W.orderBy("ym"))
    growth = money_ratio((F.col("revenue") - F.col("_prior")) * 100, F.col("_prior"), 2)
    return months.withColumn("_prior", prior).select(
        "ym", F.round("revenue", 2).alias("revenue"), F.round("_prior", 2).alias("prev_year_revenue"),
        growth.alias("yoy_growth_pct"),
    )
