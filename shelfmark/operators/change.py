"""Incremental change: upsert, conditional and keyed updates, load checks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import fresh_path


PARTITIONS_AT_ONCE = 100  # partitions named in one filter


class DuplicateKeyError(ValueError):
    """The increment names a key twice, so there is no single new version of it."""


class MissingKeyError(ValueError):
    """The increment has a row without a key, which no later run could find again."""


class MovedKeyError(ValueError):
    """An update would move a key to another partition."""


def check_keys(source: DataFrame, key: str) -> None:
    """Refuse an increment with a repeated or a missing key, as a merge would."""
    wrong = source.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col(key).isNull() | (F.col("_rows") > 1))
    missing = [row[key] is None for row in wrong.limit(1).collect()]
    if missing == [True]:
        raise MissingKeyError(f"the source has rows without {key}")
    if missing:
        raise DuplicateKeyError(f"the source repeats values of {key}")


def _merged(target: DataFrame, source: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    untouched = target.join(keys.select(key), key, "left_anti")
    return untouched.select(*target.columns).unionByName(source.select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of `target` replaced by the row of `source` with the same key, new keys added.

    The increment is checked for repeated and missing keys first.
    """
    check_keys(source, key)
    return _merged(target, source, source, key)


def within_partitions(df: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """The rows of some partitions, NULL among them or not, by literals, so that a scan opens no other directory."""
    named = [v for v in values if v is not None]
    wanted = F.col(partition).isin(*named) if named else F.lit(False)
    return df.filter(wanted if len(named) == len(values) else wanted | F.col(partition).isNull())


def partition_batches(df: DataFrame, partition: str, size: int = PARTITIONS_AT_ONCE) -> Iterator[list]:
    """The values of a partition column in order, `size` at a time; the driver never holds them all."""
    values = (row[0] for row in df.select(partition).distinct().orderBy(partition).toLocalIterator())
    while batch := list(islice(values, size)):
        yield batch


def upsert_partitions(path: str, source: DataFrame, key: str, partition: str, at_once: int = PARTITIONS_AT_ONCE) -> int:
    """Upsert into a Parquet directory partitioned by `partition`, reading and rewriting only the partitions the source
    touches; returns the number of batches they were taken in.

    NULL is a partition like any other. A key must not come from a partition that the source leaves alone; whether one does
    is told from the key column, the only one read of the whole table. The increment is staged by partition, and the new rows of each batch
    of partitions after it, in the shared folder before the table changes, so they are complete. Partitions are then replaced batch by batch: a
    run that fails in between leaves some of them old, and running the same upsert again completes it.
    """
    spark = source.sparkSession
    check_keys(source, key)
    target = spark.read.parquet(path)
    kinds = dict(target.dtypes)
    stage = fresh_path(spark, "stage")
    source.select(*(F.col(c).cast(kinds[c]).alias(c) for c in target.columns)).write.partitionBy(partition).parquet(f"{stage}/source")
    staged = spark.read.schema(target.schema).parquet(f"{stage}/source")

    touched = staged.select(F.col(partition).alias("_touched")).distinct()
    found = target.select(key, partition).join(staged.select(key), key, "left_semi")
    if not found.join(touched, F.col(partition).eqNullSafe(F.col("_touched")), "left_anti").isEmpty():
        raise MovedKeyError(f"the source moves values of {key} to another {partition}")

    batches = 0
    for values in partition_batches(staged, partition, at_once):
        old, new = (within_partitions(df, partition, values) for df in (target, staged))
        _merged(old, new, staged, key).write.partitionBy(partition).parquet(f"{stage}/batch-{batches}")
        batches += 1
    for n in range(batches):
        rows = spark.read.schema(target.schema).parquet(f"{stage}/batch-{n}")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    spark.catalog.refreshByPath(path)
    return batches


def upsert_counts(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: how many source rows update and how many insert."""
    known = target.select(key).distinct().withColumn("_known", F.lit(True))
    matched = F.col("_known").isNotNull()
    return source.select(key).join(known, key, "left").agg(
        F.count_if(matched).alias("rows_to_update"), F.count_if(~matched).alias("rows_to_insert"),
    )


def conditional_update(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    """`UPDATE df SET column = value WHERE condition`."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def replace_null(df: DataFrame, column: str, value: str) -> DataFrame:
    return conditional_update(df, column, F.col(column).isNull(), F.lit(value))


def apply_stock_deltas(products: DataFrame, deltas: DataFrame, key: str = "product_id",
                       stock: str = "stock_qty", amount: str = "quantity") -> DataFrame:
    """Subtract the summed deltas of each key from its stock; keys without deltas keep theirs."""
    taken = deltas.groupBy(key).agg(F.sum(amount).alias("_taken"))
    left = F.col(stock) - F.coalesce(F.col("_taken"), F.lit(0))
    return products.join(taken, key, "left").withColumn(stock, left.cast("bigint")).select(*products.columns)


def upsert_validation(before: DataFrame, after: DataFrame, source: DataFrame, key: str,
                      label: str, prefix: str) -> DataFrame:
    """`check, expected, actual, passed` after a load: growth equals the inserts, no key twice, and
    as many rows whose `label` starts with `prefix` as the source brought on top of the rows it left
    untouched."""
    marked = F.count_if(F.col(label).startswith(prefix))
    kept = before.join(source.select(key), key, "left_anti")
    counts = upsert_counts(before, source, key)
    keys_after = after.groupBy(key).agg(F.count("*").alias("_n"), marked.alias("_marked"))
    # Every fact is one row (name, value); together they make one wide row.
    facts = {
        "rows_before": before.agg(F.count("*")),
        "rows_after": keys_after.agg(F.sum("_n")),
        "repeated": keys_after.agg(F.count_if(F.col("_n") > 1)),
        "marked_after": keys_after.agg(F.sum("_marked")),
        "marked_kept": kept.agg(marked),
        "marked_brought": source.agg(marked),
        "rows_to_insert": counts.select("rows_to_insert"),
    }
    named = [fact.toDF("value").select(F.lit(n).alias("name"), "value") for n, fact in facts.items()]
    line = reduce(DataFrame.unionByName, named).agg(*(
        F.coalesce(F.max(F.when(F.col("name") == n, F.col("value"))), F.lit(0)).alias(n) for n in facts
    ))
    checks: Sequence[tuple[str, Column, Column]] = (
        ("row_delta", F.col("rows_to_insert"), F.col("rows_after") - F.col("rows_before")),
        ("duplicate_keys", F.lit(0).cast("bigint"), F.col("repeated")),
        ("new_rows_by_prefix", F.col("marked_kept") + F.col("marked_brought"), F.col("marked_after")),
    )
    rows = F.array(*(
        F.struct(F.lit(n).alias("check"), e.alias("expected"), a.alias("actual"), (e == a).cast("int").alias("passed"))
        for n, e, a in checks
    ))
    return line.select(F.explode(rows).alias("_row")).select("_row.*")
