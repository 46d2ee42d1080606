"""Joins between a table with one row per key and a table with many, where one key may be hot.

AQE can split a hot key only on the preserved side of an outer join, so the outer forms below keep
the many-rows table on that side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_all_of_one(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """`one LEFT JOIN many`: the matches, plus the rows of `one` whose key `many` never names.

    Written as an inner join and an anti join against the distinct keys, because a left join could
    not split a hot key of `many`.
    """
    matched = one.join(many, key)
    unmatched = one.join(many.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def keep_all_of_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """`one RIGHT JOIN many`, with the many-rows table as the preserved side."""
    return many.join(one, key, "left")


def keep_all(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """`one FULL JOIN many`: every row of `many`, plus the rows of `one` without a match."""
    unmatched = one.join(many.select(key).distinct(), key, "left_anti")
    return keep_all_of_many(one, many, key).unionByName(unmatched, allowMissingColumns=True)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of `child` whose key is missing in `parent`; a NULL key counts as missing."""
    return child.join(parent.select(key), key, "left_anti")


def referenced(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of `child` whose key exists in `parent`."""
    return child.join(parent.select(key), key, "left_semi")


def orphan_count(child: DataFrame, key: str, parent: DataFrame, parent_key: str, count_null: bool = True) -> DataFrame:
    """One row with the number of orphan rows (`violations`).

    The child is first counted per key, so a hot key crosses the shuffle as one row.
    """
    counted = child.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    if not count_null:
        counted = counted.filter(F.col("_key").isNotNull())
    missing = counted.join(parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations"))
