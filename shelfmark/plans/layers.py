"""Whole layers: each job maps the tables of one layer to those of the next.

raw -> clean -> silver -> gold for the lakehouse, raw -> clean for the store, and the incremental
load of a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import change, dedupe, joins, quality
from shelfmark.plans import clean, marts, privacy
from shelfmark.session import durable
from shelfmark.sources import files, tables

Layer = dict[str, DataFrame]


def read_layer(spark: SparkSession, path: str, names: Mapping[str, object]) -> Layer:
    """The Parquet tables of a layer."""
    return {name: files.read_parquet(spark, f"{path}/{name}") for name in names}


def write_layer(layer: Mapping[str, DataFrame], path: str) -> None:
    """Write every table of a layer below one path. Each layer is read back from there by the next,
    so no job recomputes the layers before it."""
    for name, df in layer.items():
        files.write_parquet(df, f"{path}/{name}")


# Lakehouse -------------------------------------------------------------------------------------

def clean_lake(raw: Layer) -> Layer:
    return {
        "customers": clean.clean_customers(raw["customers"]),
        "products": clean.clean_lake_products(raw["products"]),
        "orders": clean.clean_lake_orders(raw["orders"]),
        "payments": clean.clean_payments(raw["payments"]),
    }


def silver_lake(cleaned: Layer, as_of: Column, secret: str | None = None) -> Layer:
    """Only masked and tokenised tables; products hold nothing personal and pass through."""
    return {
        "customers_secure": privacy.mask_customers(cleaned["customers"], as_of, secret),
        "orders_clean": privacy.tokenize_orders(cleaned["orders"], secret),
        "payments_secure": privacy.mask_payments(cleaned["payments"]),
        "products_clean": cleaned["products"],
    }


def gold_lake(silver: Layer) -> Layer:
    """The five marts. The orders are summed per product, customer and month in one pass, whose sums are written once;
    so is the product mart, which the category marts roll up."""
    sums = durable(marts.order_sums(silver["orders_clean"]))
    by_product = durable(marts.sales_from_sums(sums, silver["products_clean"]))
    return {
        "sales_summary": by_product,
        "customer_summary": marts.customers_from_sums(sums, silver["customers_secure"]),
        "product_summary": marts.roll_up_products(by_product),
        "category_revenue": marts.roll_up_revenue(by_product),
        "monthly_revenue": marts.months_from_sums(sums),
    }


# Store -----------------------------------------------------------------------------------------

def clean_store(raw: Layer, as_of: Column) -> Layer:
    """Clean the four store tables; items of rejected orders and products leave with them. The orders
    and products the items are checked against are written once."""
    orders = durable(clean.clean_orders(raw["orders"], as_of))
    products = durable(clean.clean_products(raw["products"]))
    return {
        "customers": clean.flag_email_valid(raw["customers"]),
        "products": products,
        "orders": orders,
        "order_items": clean.clean_order_items(raw["order_items"], orders, products),
        "rejected_items": clean.quarantine_order_items(raw["order_items"], orders, products),
    }


# Incremental load ------------------------------------------------------------------------------

class OrphanError(ValueError):
    """Rows point at a parent that does not exist."""


def append_checked(rows: DataFrame, name: str, key: str, references: Sequence[quality.Reference]) -> DataFrame:
    """Append new rows to a table after checking their foreign keys, all or none: nothing is written if one fails. Returns the
    rows that `tables.append_new_rows` rejects for their key; with the references given there, orphans are rejected one by one instead."""
    for ref in references:
        missing = joins.orphan_count(rows, ref.column, ref.parent, ref.parent_key, count_null=False).first()["violations"]
        if missing:
            raise OrphanError(f"{missing} rows for {name} have no {ref.column}")
    return tables.append_new_rows(rows, name, key)


def remove_duplicates(spark: SparkSession, name: str, key: str, folder: str) -> None:
    """Keep one row per key of a table; nothing is written where no key repeats."""
    rows = tables.read_table(spark, name)
    if not dedupe.repeated_keys(rows, [key]).isEmpty():
        tables.replace_table(dedupe.dedupe_by_key(rows, [key]), name, folder)


def incremental_load(source: DataFrame, name: str, key: str, folder: str, label: str, prefix: str) -> DataFrame:
    """Upsert `source` into a table and return the checks of `upsert_validation`.

    The rows before the load stay readable in their own directory, so the checks compare the stored
    tables of both sides.
    """
    spark = source.sparkSession
    location = spark.sql(f"DESCRIBE FORMATTED {name}").filter(F.col("col_name") == "Location").first()["data_type"]
    before = files.read_parquet(spark, location)
    tables.replace_table(change.upsert(before, source, key), name, folder)
    return change.upsert_validation(before, tables.read_table(spark, name), source, key, label, prefix)
