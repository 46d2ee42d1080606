"""One row per key, with a fixed survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep, per key, the row that comes first by `order_by` and then by all other columns.

    A minimum over row structs, not a window: each task reduces its copies of a key to one row
    before the shuffle, so a key with very many copies stays cheap. NULLs come first.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    lead = [c for c in order_by if c not in keys]
    ranked = lead + [c for c in rest if c not in lead]
    first = F.min(F.struct(*ranked)).alias("_first")
    return df.groupBy(*keys).agg(first).select(
        *(F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns)
    )


def first_row(columns: Sequence[str], order: Sequence[Column]) -> Column:
    """Aggregate: struct of `columns` in the first row by `order`."""
    return F.min_by(F.struct(*columns), F.struct(*order))


def last_row(columns: Sequence[str], order: Sequence[Column]) -> Column:
    """Aggregate: struct of `columns` in the last row by `order`."""
    return F.max_by(F.struct(*columns), F.struct(*order))


def repeated_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Keys found in more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)
