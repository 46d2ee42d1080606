"""Split a flat sales table into customers, products and order lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give all columns new names by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} names")
    return df.toDF(*names)


def split_customers(flat: DataFrame) -> DataFrame:
    """One row per customer with the attributes seen most often; ties go to the smallest values.

    Lines are counted per attribute combination first, so the pick per customer compares a few
    counts and not all lines.
    """
    attributes = ["customer_name", "segment", "region", "state", "city"]
    seen = flat.groupBy("customer_id", *attributes).agg(F.count("*").alias("_lines"))
    usual = F.min(F.struct((-F.col("_lines")).alias("_rarity"), *attributes)).alias("_usual")
    return seen.groupBy("customer_id").agg(usual).select("customer_id", *(f"_usual.{a}" for a in attributes))


def split_products(flat: DataFrame) -> DataFrame:
    """Distinct products; an id sold under two names stays twice."""
    return flat.select("product_id", "product_name", "category", "sub_category").distinct()


def split_orders(flat: DataFrame) -> DataFrame:
    """Order lines with references to customer and product."""
    return flat.select(
        "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id",
        "sales", "quantity", "discount", "profit",
    )
