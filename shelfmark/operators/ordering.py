"""Row numbers, ranks and running sums over a whole table, and top-k with ties.

A window without a partition key would move every row to one task. Here the rows are range
partitioned by the sort keys instead and each slice starts counting where the slices before it
end. Only one summary row per slice is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.session import durable

SAMPLED = 64  # sort keys sampled for each slice that explicit bounds cut
SLICE_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def _offsets(placed: DataFrame, running: Sequence[str]) -> DataFrame:
    """Rows and sums of the slices before each slice, and of all. One row per slice: at most spark.sql.shuffle.partitions rows,
    whatever the data size."""
    sizes = placed.groupBy("_slice").agg(
        F.count("*").alias("_rows"), *(F.sum(c).alias(f"_sum_{c}") for c in running)
    )
    earlier = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    zero = F.lit(0)
    return sizes.select(
        "_slice",
        F.coalesce(F.sum("_rows").over(earlier), zero).alias("_rows_before"),
        F.sum("_rows").over(every).alias("row_count"),
        *(F.coalesce(F.sum(f"_sum_{c}").over(earlier), zero).alias(f"_before_{c}") for c in running),
        *(F.sum(f"_sum_{c}").over(every).alias(f"total_{c}") for c in running),
    )


def number_rows(df: DataFrame, keys: Sequence[Column], running: Sequence[str] = (),
                slices: int | None = None) -> DataFrame:
    """Add `row_number` and `row_count` over the order `keys`, and for each column c in `running`
    the sums `running_c` (up to and including the row) and `total_c`.

    `keys` must order the rows totally. Slices are written once, so that the counting and the
    numbering see the same ones. Their number follows the data size (AQE) unless `slices` fixes it.
    """
    ranges = df.repartitionByRange(*keys) if slices is None else df.repartitionByRange(slices, *keys)
    placed = durable(
        ranges.sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_at", SLICE_BITS))

    offsets = _offsets(placed, running)
    zero = F.lit(0)
    within = F.col("_at").bitwiseAND(F.lit((1 << SLICE_BITS) - 1))
    numbered = placed.join(F.broadcast(offsets), "_slice").withColumn("row_number", F.col("_rows_before") + within + 1)
    if running:
        so_far = W.partitionBy("_slice").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
        for c in running:
            in_slice = F.coalesce(F.sum(c).over(so_far), zero)
            numbered = numbered.withColumn(f"running_{c}", F.col(f"_before_{c}") + in_slice)
    return numbered.drop("_at", "_slice", "_rows_before", *(f"_before_{c}" for c in running))


@dataclass(frozen=True)
class Key:
    """A column to sort by. NULL comes first, or last where the order is descending."""

    column: str
    descending: bool = False  # numbers only

    def comparable(self) -> list[Column]:
        """Columns whose ascending order is that of the key."""
        value = F.col(self.column)
        return [value.isNull(), -value] if self.descending else [value]


def _bounds(df: DataFrame, keys: Sequence[Key], slices: int) -> list[Column]:
    """At most `slices - 1` sort keys that cut the rows into slices of about equal size, from a sample of bounded size."""
    parts = [c.alias(f"_{i}") for i, c in enumerate(c for k in keys for c in k.comparable())]
    sample = df.select(*parts).orderBy(F.xxhash64(*(f"_{i}" for i in range(len(parts))))).limit(SAMPLED * slices)
    ordered = sample.distinct().orderBy(*sample.columns)
    found = ordered.collect()  # SAMPLED rows for each slice at most
    kinds = [f.dataType for f in sample.schema.fields]
    cuts = sorted({len(found) * i // slices for i in range(1, slices)} - {0})
    return [F.struct(*(F.lit(v).cast(kind).alias(f"_{i}") for i, (v, kind) in enumerate(zip(found[at], kinds)))) for at in cuts]


def running_sums(df: DataFrame, keys: Sequence[Key], running: Sequence[str], slices: int | None = None) -> DataFrame:
    """As `number_rows` with `running`, but the rows are shuffled and sorted once: slices are told by bounds over the whole sort key,
    so numbers and sums come from one window per slice. `keys` must order the rows totally.

    `df` is written once, since the sample, the sizes and the window read it. A value shared by many rows is
    cut by the keys after it.
    """
    base = durable(df)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(base, keys, slices)
    own = F.struct(*(c.alias(f"_{i}") for i, c in enumerate(c for k in keys for c in k.comparable())))
    at = F.size(F.filter(F.array(*bounds), lambda bound: bound <= own)) if bounds else F.lit(0)
    placed = base.withColumn("_slice", at)

    offsets = _offsets(placed, running)
    so_far = W.partitionBy("_slice").orderBy(*(c for k in keys for c in k.comparable()))
    sums = so_far.rowsBetween(W.unboundedPreceding, 0)
    counted = placed.withColumns({
        "_row": F.row_number().over(so_far), **{f"_in_{c}": F.coalesce(F.sum(c).over(sums), F.lit(0)) for c in running}})
    joined = counted.join(F.broadcast(offsets), "_slice")
    return joined.select(
        *df.columns, (F.col("_rows_before") + F.col("_row")).alias("row_number"), "row_count",
        *(x for c in running for x in ((F.col(f"_before_{c}") + F.col(f"_in_{c}")).alias(f"running_{c}"), F.col(f"total_{c}"))))


def number_from_group_start(numbered: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Number rows 1, 2, ... inside each group of an order that keeps groups together."""
    return _with_start(numbered, group).withColumn(name, F.col("row_number") - F.col("_start") + 1).drop("_start")


def rank_of_value(numbered: DataFrame, value: Sequence[str], name: str) -> DataFrame:
    """RANK: all rows of equal `value` take the first row number among them."""
    return _with_start(numbered, value).withColumnRenamed("_start", name)


def _with_start(numbered: DataFrame, columns: Sequence[str]) -> DataFrame:
    # Grouping first leaves one row per value; the join back can split a hot value.
    start = numbered.groupBy(*columns).agg(F.min("row_number").alias("_start"))
    start = start.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns]
    return numbered.join(start, same).drop(*(f"_of_{c}" for c in columns))


def ntile(row_number: Column, row_count: Column, buckets: int) -> Column:
    """NTILE from a row number: the first `row_count mod buckets` buckets hold one row more."""
    small = F.floor(row_count / buckets)
    larger = row_count % buckets
    in_larger = larger * (small + 1)
    return (
        F.when(row_number <= in_larger, F.floor((row_number - 1) / (small + 1)) + 1)
        .otherwise(larger + F.floor((row_number - 1 - in_larger) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )


def ranked_top(df: DataFrame, value: str, k: int, name: str, ascending: bool = False) -> DataFrame:
    """All rows whose RANK over `value` is at most `k`, ties kept, with the rank in `name`.

    NULL is the lowest value: first when ascending, last otherwise. `df` is written once; the k best values (k rows at most)
    settle both the cut and the ranks, and the stored rows are only filtered against them.
    """
    rows = durable(df)
    best = rows.select(F.col(value).alias("_best")).orderBy(order_of("_best", ascending)).limit(k)
    ranks = best.select("_best", F.rank().over(W.orderBy(order_of("_best", ascending))).alias(name)).distinct()
    return rows.join(F.broadcast(ranks), F.col(value).eqNullSafe(F.col("_best"))).drop("_best")


def order_of(value: str, ascending: bool) -> Column:
    """The order of RANK: NULL counts as the lowest value."""
    return F.col(value).asc_nulls_first() if ascending else F.col(value).desc_nulls_last()
