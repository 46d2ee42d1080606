"""Column and table profiles. Each reads its table once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long_form(wide: DataFrame, names: Sequence[str], fields: Sequence[str]) -> list[Column]:
    return [F.struct(F.lit(n).alias("_name"), *(F.col(f"{n}__{f}").alias(f) for f in fields)) for n in names]


def _melt(wide: DataFrame, names: Sequence[str], fields: Sequence[str], label: str) -> DataFrame:
    """One row with columns `name__field` becomes one row per name."""
    rows = F.explode(F.array(*_long_form(wide, names, fields))).alias("_row")
    return wide.select(rows).select(F.col("_row._name").alias(label), *(F.col(f"_row.{f}") for f in fields))


def null_counts(df: DataFrame) -> DataFrame:
    """Number of NULLs of every column: `column_name, null_count`."""
    wide = df.agg(*(F.count_if(F.col(c).isNull()).alias(f"{c}__null_count") for c in df.columns))
    return _melt(wide, df.columns, ["null_count"], "column_name")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of the given columns."""
    fields = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    wide = df.agg(*(
        (fn(c) if f == "count" else F.round(fn(F.col(c).cast("double")), 4)).alias(f"{c}__{f}")
        for c in columns for f, fn in fields.items()
    ))
    return _melt(wide, columns, list(fields), "column_name")


def _distinct_rows(df: DataFrame) -> DataFrame:
    """Every different row with its number of copies; copies merge before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """One row: total, distinct_rows, exact_duplicates, duplicate_keys (rows beyond one per key)."""
    counts = _distinct_rows(df).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total"),
        F.count("*").alias("distinct_rows"),
        F.count_distinct(F.struct(key)).alias("_keys"),
    )
    return counts.select(
        "total", "distinct_rows",
        (F.col("total") - F.col("distinct_rows")).alias("exact_duplicates"),
        (F.col("total") - F.col("_keys")).alias("duplicate_keys"),
    )


def quality_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: dataset, row_count, total_nulls, exact_duplicates."""
    def summary(name: str, df: DataFrame) -> DataFrame:
        nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
        return _distinct_rows(df).agg(
            F.lit(name).alias("dataset"),
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.col("_copies") * nulls), F.lit(0)).alias("total_nulls"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("exact_duplicates"),
        )
    return reduce(DataFrame.unionByName, [summary(n, d) for n, d in tables.items()])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Labelled row count per table."""
    counts = [d.agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n, d in tables.items()]
    return reduce(DataFrame.unionByName, counts)
