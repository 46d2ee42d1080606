"""Everyday questions to the order schema: customers, products, orders, order items."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.money import average, total
from shelfmark.functions.text import tier
from shelfmark.operators.joins import keep_all, keep_all_of_many, keep_all_of_one


# Selections ------------------------------------------------------------------------------------

def by_status(orders: DataFrame, status: str) -> DataFrame:
    return orders.filter(F.col("status") == status)


def by_category_above(products: DataFrame, category: str, price: float) -> DataFrame:
    return products.filter((F.col("category") == category) & (F.col("unit_price") > price))


def by_age_and_plan(people: DataFrame, low: int, high: int, plan: str) -> DataFrame:
    """Age range, both ends included, and one subscription."""
    return people.filter(F.col("age").between(low, high) & (F.col("subscription") == plan))


def placed_between(orders: DataFrame, first: date, last: date, without: str) -> DataFrame:
    """Orders of a date range, both ends included, but for one status."""
    return orders.filter(F.col("order_date").between(F.lit(first), F.lit(last)) & (F.col("status") != without))


def placed_in_year(orders: DataFrame, year: int) -> DataFrame:
    """Orders of a year, as a half-open range that reaches the Parquet scan."""
    day = F.col("order_date")
    return orders.filter((day >= F.lit(date(year, 1, 1))) & (day < F.lit(date(year + 1, 1, 1))))


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def price_tiers(products: DataFrame, budget: float = 1000, premium: float = 3000) -> DataFrame:
    """`Budget` below the first bound, `Premium` above the second, `Mid-Range` between."""
    price = F.col("unit_price")
    label = F.when(price > premium, "Premium").otherwise(tier(price, [(budget, "Budget")], "Mid-Range"))
    return products.select("product_id", "product_name", "unit_price", label.alias("price_tier"))


# Joins -----------------------------------------------------------------------------------------

def orders_with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id").select(
        "order_id", "order_date", "customer_name", "total_amount")


def customers_with_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All customers, with their orders where they have any."""
    return keep_all_of_one(
        customers.select("customer_id", "customer_name"),
        orders.select("customer_id", "order_id", "order_date", "total_amount"), "customer_id",
    )


def orders_with_any_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All orders, with the customer where known."""
    return keep_all_of_many(
        customers.select("customer_id", "customer_name"), orders.select("customer_id", "order_id"), "customer_id",
    ).select("customer_name", "order_id")


def customers_and_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """All customers and all orders, matched where possible."""
    return keep_all(
        customers.select("customer_id", "customer_name"), orders.select("customer_id", "order_id"), "customer_id",
    ).select("customer_id", "customer_name", "order_id")


def item_details(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        items.join(orders.select("order_id"), "order_id")
        .join(products.select("product_id", "product_name"), "product_id")
        .select("item_id", "order_id", "product_name", "quantity", "unit_price", "discount_percent")
    )


# Figures ---------------------------------------------------------------------------------------

def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def count_distinct(df: DataFrame, column: str, name: str, approximate: bool = False) -> DataFrame:
    """Distinct values of a column; `approximate` trades exactness for a sketch of fixed size."""
    counted = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(counted.alias(name))


def revenue_of_status(orders: DataFrame, status: str) -> DataFrame:
    return by_status(orders, status).agg(total(F.col("total_amount")).alias("total_revenue"))


def avg_price_by_category(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(average(F.col("unit_price")).alias("avg_price"))


def categories_above(products: DataFrame, price: float) -> DataFrame:
    """Categories whose mean price exceeds a bound."""
    mean = F.sum("unit_price") / F.count("unit_price")
    return products.groupBy("category").agg(mean.alias("_mean"), average(F.col("unit_price")).alias("avg_price")).filter(
        F.col("_mean") > price).select("category", "avg_price")


def status_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(
        F.count("*").alias("total_orders"), total(F.col("total_amount")).alias("total_revenue"),
    ).orderBy(F.col("total_revenue").desc(), "status")


def status_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(
        F.count("*").alias("order_count"), total(F.col("total_amount")).alias("sum_total_amount"))


def price_extremes(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(
        F.max("unit_price").alias("most_expensive"), F.min("unit_price").alias("cheapest"))


def delivered_or_not(orders: DataFrame, status: str = "DELIVERED") -> DataFrame:
    """Delivered and other orders in one row."""
    return orders.agg(
        F.count_if(F.col("status") == status).alias("delivered_orders"),
        F.count_if(F.col("status") != status).alias("not_delivered_orders"))


def region_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region").agg(total(F.col("sales")).alias("total_sales"))
