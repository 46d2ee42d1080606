"""Catalog tables stored as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.quality import Reference, judge_batch
from shelfmark.session import fresh_path


def save_table(df: DataFrame, name: str, path: str | None = None,
               bucket_by: tuple[int, str] | None = None, partition_by: Sequence[str] = ()) -> None:
    """Create or overwrite a table.

    `bucket_by=(n, key)` stores the rows hashed and sorted by a key, so that later joins and
    groupings on it need no shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, key = bucket_by
        writer = writer.bucketBy(count, key).sortBy(key)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def append_new_rows(rows: DataFrame, name: str, key: str, references: Sequence[Reference] = ()) -> DataFrame:
    """Append to a table what `judge_batch` accepts of a batch and return the rejected rows with `reject_reason` and `copies`: rows
    appended plus copies rejected equal the batch. A second run appends nothing.

    The verdicts are written to the shared folder before the table changes, so both parts are those of one judgement.
    """
    spark = rows.sparkSession
    columns = spark.table(name).columns
    stage = fresh_path(spark, "append")
    judge_batch(rows.select(*columns), spark.table(name), key, references).write.parquet(stage)
    judged = spark.read.parquet(stage)
    judged.filter(F.col("reject_reason").isNull()).select(*columns).write.mode("append").insertInto(name)
    return judged.filter(F.col("reject_reason").isNotNull())


def replace_table(df: DataFrame, name: str, folder: str) -> None:
    """Give a table new contents that may be computed from its old ones.

    The rows go to a fresh directory first and the table then switches to it. A failure before the
    switch leaves the old table as it was.
    """
    spark = df.sparkSession
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
