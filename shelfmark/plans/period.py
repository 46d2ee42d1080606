"""Revenue of a period: breakdown, comparison with the period before, best products."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.dates import month_key, week_key
from shelfmark.functions.money import percent_change, percent_change_text, total

UNITS = {
    "daily": lambda day: day.cast("string"),
    "weekly": week_key,
    "monthly": month_key,
}


def _between(start: date, end: date) -> Column:
    if start > end:
        raise ValueError("the period must not end before it starts")
    return F.col("order_date").between(F.lit(start), F.lit(end))


def previous_window(start: date, end: date) -> tuple[date, date]:
    """The window of equal length that ends the day before `start`."""
    last = start - timedelta(days=1)
    return last - (end - start), last


def period_breakdown(rev: DataFrame, unit: str, start: date, end: date) -> DataFrame:
    """Orders and revenue per day, week or month of the period."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    return rev.filter(_between(start, end)).groupBy(UNITS[unit](F.col("order_date")).alias("period")).agg(
        F.count_distinct("order_id").alias("orders"), total(F.col("net_revenue")).alias("revenue"),
    )


def period_top_products(rev: DataFrame, products: DataFrame, start: date, end: date, k: int = 3) -> DataFrame:
    """The k products with the highest revenue in the period."""
    sums = rev.filter(_between(start, end)).groupBy("product_id").agg(total(F.col("net_revenue")).alias("revenue"))
    named = sums.join(products.select("product_id", "product_name"), "product_id")
    return named.select("product_id", "product_name", "revenue").orderBy(F.col("revenue").desc(), "product_id").limit(k)


def period_comparison(rev: DataFrame, start: date, end: date) -> DataFrame:
    """Orders, revenue and customers of the period against the window before it, from one scan:
    `metric, current, previous, change` plus the change as a number in `change_pct`."""
    before_start, before_end = previous_window(start, end)
    both = rev.filter(_between(before_start, end))
    window = F.when(F.col("order_date") >= F.lit(start), F.lit("current")).otherwise(F.lit("previous"))
    # An order has one customer, so orders are counted while their lines are merged, and customers while their orders are:
    # window, order and customer first, then window and customer, then the window.
    orders = both.groupBy(window.alias("_window"), "order_id", "customer_id").agg(F.sum("net_revenue").alias("_net"))
    customers = orders.groupBy("_window", "customer_id").agg(F.count("order_id").alias("_orders"), F.sum("_net").alias("_net"))
    measures = customers.groupBy("_window").agg(
        F.sum("_orders").alias("orders"), total(F.col("_net")).alias("revenue"), F.count("customer_id").alias("unique_customers"))
    names = ("orders", "revenue", "unique_customers")

    def of(window_name: str, measure: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("_window") == window_name, F.col(measure))).cast("double"), F.lit(0.0))

    wide = measures.agg(*(
        of(w, m).alias(f"{m}_{w}") for m in names for w in ("current", "previous")
    ))
    rows = F.array(*(
        F.struct(F.lit(m).alias("metric"), F.col(f"{m}_current").alias("current"), F.col(f"{m}_previous").alias("previous"))
        for m in names
    ))
    current, previous = F.col("current"), F.col("previous")
    return wide.select(F.explode(rows).alias("_row")).select("_row.*").withColumns({
        "change": percent_change_text(current, previous), "change_pct": percent_change(current, previous),
    })


def period_report(rev: DataFrame, products: DataFrame, unit: str, start: date, end: date) -> dict[str, DataFrame]:
    """The whole report: comparison with the window before, best products, breakdown."""
    return {
        "summary": period_comparison(rev, start, end),
        "top_products": period_top_products(rev, products, start, end),
        "breakdown": period_breakdown(rev, unit, start, end).orderBy("period"),
    }
