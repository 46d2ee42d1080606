"""Values at the edges: NULL partitions and keys, very large denominators and numbers, NULL ranks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import registry
from shelfmark.functions.money import ratio
from shelfmark.operators import change, ordering
from shelfmark.plans import clean
from shelfmark.sources import tables
from tests.conftest import SMALL, physical

ROW = "k int, v string, m string"


def test_null_partition_keeps_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2"), (3, "c", None), (4, "d", None)], ROW).write.partitionBy("m").parquet(path)
    change.upsert_partitions(path, spark.createDataFrame([(1, "A", "m1"), (3, "C", None), (5, "e", "m3")], ROW), "k", "m")
    rows = sorted((r.k, r.v, r.m) for r in spark.read.parquet(path).collect())
    assert rows == [(1, "A", "m1"), (2, "b", "m2"), (3, "C", None), (4, "d", None), (5, "e", "m3")]
    for moved in ([(1, "A", "m2"), (9, "x", None)], [(3, "C", "m1")], [(2, "b", None)]):
        with pytest.raises(change.MovedKeyError):
            change.upsert_partitions(path, spark.createDataFrame(moved, ROW), "k", "m")


@pytest.mark.parametrize("n", [3, 10**12, 10**15, 2**63 - 1])
def test_ratio_takes_any_count(spark, n):
    row = spark.range(1).select(ratio(F.lit("2.000000").cast("decimal(20,6)") * 10**6, F.lit(n), 4).alias("r")).first()
    assert float(row.r) == pytest.approx(round(2e6 / n, 4))


def test_long_numbers_are_null_not_errors(spark):
    items = spark.createDataFrame([("99999999999", "1.00", "0"), ("5", "1.50", "x")], "quantity string, unit_price string, discount_percent string")
    assert [(r.quantity, r.discount_percent) for r in clean.typed_items(items).collect()] == [(None, 0), (5, None)]


def test_rank_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("c", 1), ("d", 2)], "id string, v int")
    low = {r.id: r.n for r in ordering.ranked_top(df, "v", 3, "n", ascending=True).collect()}
    high = {r.id: r.n for r in ordering.ranked_top(df, "v", 3, "n").collect()}
    assert low == {"a": 1, "b": 1, "c": 3} and high == {"d": 1, "c": 2, "a": 3, "b": 3}


def test_append_takes_one_row_per_key_and_none_without(spark):
    name = "append_edges"
    tables.drop_table(spark, name)
    spark.createDataFrame([(1, "a")], "k int, v string").write.saveAsTable(name)
    batch = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c"), (2, "d"), (None, "e")], "k int, v string")
    for _ in range(2):
        tables.append_new_rows(batch, name, "k")
    assert sorted((r.k, r.v) for r in spark.table(name).collect()) == [(1, "a"), (2, "c")]
    tables.drop_table(spark, name)


@pytest.mark.parametrize("name", ["top_order_per_customer_10", "orders_above_average_10", "customer_totals_10"])
def test_top_ten_plans(spark, name):
    assert "TakeOrderedAndProject" in physical(registry.queries()[name](spark, SMALL))
