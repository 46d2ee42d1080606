"""Order-line facts that the sales and customer jobs build on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.dates import month_key
from shelfmark.functions.money import discounted

LINE_MONEY = "decimal(18,6)"


def order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with the attributes of their order and the line measures, without product columns.

    The cheap form of `line_facts`: jobs that need product attributes add them after they have
    summed the lines per product. Items must have passed `clean_order_items`; their exact DECIMALs are taken as they
    are, and the line value is rounded once.
    """
    line_value = discounted(F.col("quantity") * F.col("unit_price"), F.col("discount_percent")).cast(LINE_MONEY)
    returned = F.col("quantity") < 0
    zero = F.lit(0).cast(LINE_MONEY)
    net = F.col("net_revenue")
    measured = items.select(
        "item_id", "order_id", "product_id", "quantity", "unit_price", "discount_percent",
        line_value.alias("net_revenue"),
    ).withColumns({
        "gross_revenue": F.when(returned, zero).otherwise(net),
        "return_value": F.when(returned, -net).otherwise(zero),
        "is_return": returned.cast("int"),
    })
    headers = orders.select(
        "order_id", "customer_id", "order_date", "status", "region_code", "is_guest",
        F.col("order_date").alias("order_day"), month_key(F.col("order_date")).alias("order_month"),
    )
    return measured.join(headers, "order_id")


def line_facts(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One wide row per order line: item, order and product attributes plus the measures."""
    attributes = products.select("product_id", "category", "subcategory", "product_name", "cost_price")
    return order_lines(items, orders).join(attributes, "product_id").select(
        "item_id", "order_id", "product_id", "customer_id", "order_date", "status", "region_code",
        "is_guest", "category", "subcategory", "product_name", "cost_price", "quantity", "unit_price",
        "discount_percent", "order_day", "order_month", "net_revenue", "gross_revenue", "return_value",
        "is_return",
    )


def revenue_lines(lines: DataFrame, exclude: Sequence[str] = ("CANCELLED",)) -> DataFrame:
    """Lines that count as revenue: all but those of the excluded order statuses."""
    return lines.filter(~F.col("status").isin(*exclude))


def month_spine(months: DataFrame, column: str = "ym") -> DataFrame:
    """Every month between the first and the last of `column` (`yyyy-MM`), gaps included."""
    first, last = (F.to_date(F.concat(f(column), F.lit("-01"))) for f in (F.min, F.max))
    bounds = months.agg(first.alias("first"), last.alias("last"))
    every_month = F.explode(F.sequence("first", "last", F.expr("interval 1 month")))
    return bounds.select(every_month.alias("month")).select(month_key(F.col("month")).alias(column))
