"""Global order, ranks and top-k against a plain sort, with heavy ties."""

from __future__ import annotations

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.operators import ordering


@pytest.fixture(scope="module")
def scores(spark):
    """A third of the rows share one value and half of them one group."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        value = D(500) if i % 3 == 0 else D(rng.randint(-1000, 1000)) / 4
        rows.append((i, "big" if i % 2 else rng.choice("abc"), value))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id int, part string, value decimal(18,2)").repartition(7)


def best_first():
    return [F.col("value").desc(), F.col("id").asc()]


@pytest.mark.parametrize("slices", [None, 1, 6])
def test_row_numbers_and_running_sums(scores, slices):
    numbered = ordering.number_rows(scores, best_first(), ["value"], slices)
    got = {r["id"]: (r["row_number"], r["row_count"], r["running_value"], r["total_value"]) for r in numbered.collect()}
    rows = sorted(((r["id"], r["value"]) for r in scores.collect()), key=lambda r: (-r[1], r[0]))
    total, so_far = sum(v for _, v in rows), D(0)
    for place, (key, value) in enumerate(rows, 1):
        so_far += value
        assert got[key] == (place, len(rows), so_far, total)


def test_fixed_slices_are_kept(scores):
    placed = scores.repartitionByRange(6, *best_first())
    assert placed.select(F.spark_partition_id().alias("p")).distinct().count() == 6


def test_rank_with_ties(scores):
    numbered = ordering.number_rows(scores, best_first(), slices=6)
    got = {r["id"]: r["rank"] for r in ordering.rank_of_value(numbered, ["value"], "rank").collect()}
    plain = scores.withColumn("rank", F.rank().over(W.orderBy(F.col("value").desc())))
    assert got == {r["id"]: r["rank"] for r in plain.collect()}


def test_number_within_group(scores):
    order = [F.col("part").asc(), *best_first()]
    numbered = ordering.number_from_group_start(ordering.number_rows(scores, order, slices=6), ["part"], "place")
    plain = scores.withColumn("place", F.row_number().over(W.partitionBy("part").orderBy(*best_first())))
    assert {r["id"]: r["place"] for r in numbered.collect()} == {r["id"]: r["place"] for r in plain.collect()}


@pytest.mark.parametrize("rows", [1, 3, 4, 5, 10, 11, 103])
@pytest.mark.parametrize("buckets", [1, 4, 7])
def test_ntile(spark, rows, buckets):
    df = spark.range(1, rows + 1).withColumnRenamed("id", "n")
    plain = df.withColumn("t", F.ntile(buckets).over(W.orderBy("n")))
    ours = df.withColumn("t", ordering.ntile(F.col("n"), F.lit(rows), buckets))
    assert sorted(ours.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("k", [1, 10, 700])
def test_ranked_top_keeps_ties(scores, ascending, k):
    order = F.col("value").asc() if ascending else F.col("value").desc()
    plain = scores.withColumn("rank", F.rank().over(W.orderBy(order))).filter(F.col("rank") <= k)
    ours = ordering.ranked_top(scores, "value", k, "rank", ascending)
    assert {(r["id"], r["rank"]) for r in ours.collect()} == {(r["id"], r["rank"]) for r in plain.collect()}


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id int, value decimal(18,2)")
    assert ordering.number_rows(empty, best_first(), running=["value"]).collect() == []
    assert ordering.ranked_top(empty, "value", 10, "rank").collect() == []


def keys():
    return [ordering.Key("value", descending=True), ordering.Key("id")]


@pytest.mark.parametrize("slices", [None, 1, 6, 40])
def test_running_sums(scores, slices):
    got = {r["id"]: (r["row_number"], r["row_count"], r["running_value"], r["total_value"])
           for r in ordering.running_sums(scores, keys(), ["value"], slices).collect()}
    rows = sorted(((r["id"], r["value"]) for r in scores.collect()), key=lambda r: (-r[1], r[0]))
    total, so_far = sum(v for _, v in rows), D(0)
    for place, (key, value) in enumerate(rows, 1):
        so_far += value
        assert got[key] == (place, len(rows), so_far, total)


def test_a_hot_value_is_cut_into_slices(scores):
    """A third of the rows share a value; the bounds go on to the next key inside it."""
    base = scores
    bounds = ordering._bounds(base, keys(), 12)
    own = F.struct(*(c.alias(f"_{i}") for i, c in enumerate(c for k in keys() for c in k.comparable())))
    sizes = base.groupBy(F.size(F.filter(F.array(*bounds), lambda b: b <= own)).alias("s")).count().collect()
    assert len(sizes) >= 10 and max(r["count"] for r in sizes) < 3 * base.count() / 12


def test_running_sums_with_nulls_and_without_rows(spark):
    df = spark.createDataFrame([(1, None), (2, D(3)), (3, D(5)), (None, D(4))], "id int, value decimal(18,2)")
    got = {r["id"]: (r["row_number"], r["running_value"]) for r in ordering.running_sums(df, keys(), ["value"], 3).collect()}
    assert got == {3: (1, D(5)), None: (2, D(9)), 2: (3, D(12)), 1: (4, D(12))}
    assert ordering.running_sums(df.limit(0), keys(), ["value"]).collect() == []
