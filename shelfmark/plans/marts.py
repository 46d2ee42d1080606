"""Gold marts over tokenised orders.

Orders are summed per join key before the join, so the join moves one row per product or customer
instead of one per order, and a best-selling product crosses the shuffle as one row per task. The
category marts continue from the product sums. A layer that needs several marts takes `order_sums`,
which reads the orders once for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.dates import month_key
from shelfmark.functions.money import MONEY, ratio


def _kept(orders: DataFrame, exclude: Sequence[str]) -> DataFrame:
    return orders.filter(~F.col("status").isin(*exclude)) if exclude else orders


def _measures() -> list[Column]:
    amount = F.col("total_amount").cast(MONEY)
    return [
        F.count("order_id").alias("_orders"), F.sum("quantity").alias("_units"),
        F.sum(amount).alias("_amount"), F.count(amount).alias("_amounts"),
    ]


def _sums(orders: DataFrame, key: str) -> DataFrame:
    return orders.groupBy(key).agg(*_measures())


def order_sums(orders: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """The sums every mart needs from one pass over the orders: a row per product, per customer token and per month, told
    apart by `grain`, the name of the key.

    Tokens are hexadecimal, so they are shuffled as bytes, half as long; text that is not stays as it is.
    """
    token, packed = F.col("customer_token"), F.unhex("customer_token")
    keyed = _kept(orders, exclude).withColumn("_packed", F.when(F.lower(F.hex(packed)) == token, packed)).withColumn(
        "_text", F.when(F.col("_packed").isNull(), token))
    keyed = keyed.withColumn("order_month", month_key(F.col("order_date")))
    grain = F.when(F.grouping("product_id") == 0, "product_id").when(F.grouping("order_month") == 0, "order_month").otherwise("customer_token")
    sets = [["product_id"], ["_packed", "_text"], ["order_month"]]
    return keyed.groupingSets(sets, "product_id", "_packed", "_text", "order_month").agg(
        grain.alias("grain"), *_measures(),
    ).withColumn("customer_token", F.coalesce(F.lower(F.hex("_packed")), "_text")).drop("_packed", "_text")


def _of_grain(sums: DataFrame, grain: str) -> DataFrame:
    return sums.filter(F.col("grain") == grain).select(grain, "_orders", "_units", "_amount", "_amounts")


def _revenue() -> Column:
    return F.round(F.sum("_amount"), 2)


def _average() -> Column:
    return ratio(F.sum("_amount"), F.sum("_amounts"), 2)


def sales_summary(orders: DataFrame, products: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Orders, units, revenue and average order value per product."""
    return _per_product(_sums(_kept(orders, exclude), "product_id"), products)


def sales_from_sums(sums: DataFrame, products: DataFrame) -> DataFrame:
    """`sales_summary` from stored `order_sums`."""
    return _per_product(_of_grain(sums, "product_id"), products)


def _per_product(sums: DataFrame, products: DataFrame) -> DataFrame:
    named = products.select("product_id", "product_name", "category")
    return sums.join(named, "product_id").groupBy(
        "product_id", "product_name", "category",
    ).agg(
        F.sum("_orders").alias("total_orders"), F.sum("_units").alias("total_quantity_sold"),
        _revenue().alias("total_revenue"), _average().alias("avg_order_value"),
    )


def customer_summary(orders: DataFrame, customers: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Orders, spend and average order value per customer token."""
    return _per_customer(_sums(_kept(orders, exclude), "customer_token"), customers)


def customers_from_sums(sums: DataFrame, customers: DataFrame) -> DataFrame:
    """`customer_summary` from stored `order_sums`."""
    return _per_customer(_of_grain(sums, "customer_token"), customers)


def _per_customer(sums: DataFrame, customers: DataFrame) -> DataFrame:
    people = customers.select("customer_token", "age_band", "city", "state")
    return sums.join(people, "customer_token").groupBy(
        "customer_token", "age_band", "city", "state",
    ).agg(
        F.sum("_orders").alias("total_orders"), _revenue().alias("total_spent"), _average().alias("avg_order_value"),
    )


def product_summary(orders: DataFrame, products: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Orders, units and revenue per category."""
    category = products.select("product_id", "category")
    return _sums(_kept(orders, exclude), "product_id").join(category, "product_id").groupBy("category").agg(
        F.sum("_orders").alias("total_orders"), F.sum("_units").alias("total_units_sold"),
        _revenue().alias("total_revenue"),
    )


def category_revenue(orders: DataFrame, products: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Revenue per category."""
    return _revenue_only(product_summary(orders, products, exclude))


def _revenue_only(by_category: DataFrame) -> DataFrame:
    return by_category.select("category", F.col("total_revenue").alias("category_revenue"))


def roll_up_products(by_product: DataFrame) -> DataFrame:
    """`product_summary` from a stored `sales_summary`, without reading the orders again."""
    return by_product.groupBy("category").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("total_quantity_sold").alias("total_units_sold"),
        F.round(F.sum("total_revenue"), 2).alias("total_revenue"))


def roll_up_revenue(by_product: DataFrame) -> DataFrame:
    """`category_revenue` from a stored `sales_summary`."""
    return _revenue_only(roll_up_products(by_product))


def monthly_revenue(orders: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Revenue per month."""
    return (
        _kept(orders, exclude)
        .groupBy(month_key(F.col("order_date")).alias("order_month"))
        .agg(F.round(F.sum(F.col("total_amount").cast(MONEY)), 2).alias("monthly_revenue"))
    )


def months_from_sums(sums: DataFrame) -> DataFrame:
    """`monthly_revenue` from stored `order_sums`."""
    return _of_grain(sums, "order_month").select("order_month", F.round("_amount", 2).alias("monthly_revenue"))
