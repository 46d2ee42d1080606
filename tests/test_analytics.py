"""Customer and basket analytics against brute force, on skewed input."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import change, dedupe
from shelfmark.plans import basket, clean, customers, period, sales
from tests.conftest import physical

ITEM_TEXTS = "item_id string, order_id string, product_id string, quantity string, unit_price string, discount_percent string"


def brute_pairs(rows, support):
    baskets = defaultdict(set)
    for order, product, quantity in rows:
        if quantity > 0:
            baskets[order].add(product)
    counts = Counter(p for b in baskets.values() for p in combinations(sorted(b), 2))
    return {pair: n for pair, n in counts.items() if n >= support}


@pytest.mark.parametrize("block", [1, 3, 6, 500])
@pytest.mark.parametrize("support", [2, 3])
def test_pairs_match_brute_force(spark, block, support):
    """One order holds every product, some hold many; each block size cuts the orders differently."""
    rng = random.Random(11)
    rows = [(0, p, 1) for p in range(40)]
    for order in range(1, 120):
        size = rng.choice([1, 2, 3, 5, 12])
        rows += [(order, rng.randint(0, 39), rng.choice([1, 2, -1])) for _ in range(size)]
    df = spark.createDataFrame(rows, "order_id int, product_id int, quantity int")
    found = {(r[0], r[1]): r[2] for r in basket.pair_counts(df, support, block).collect()}
    assert found == brute_pairs(rows, support)


def test_pairs_of_one_order_are_spread(spark):
    """2,000 products of one order make 1,999,000 pairs, in several tasks and none with most of them."""
    df = spark.range(2000).select(F.lit(1).alias("order_id"), F.col("id").alias("product_id"))
    pairs = basket.order_pairs(df).groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.count_distinct("product_a", "product_b").alias("different"),
        F.sum((F.col("product_a") < F.col("product_b")).cast("int")).alias("ordered")).collect()
    assert sum(r["n"] for r in pairs) == sum(r["different"] for r in pairs) == sum(r["ordered"] for r in pairs) == 1_999_000
    assert len(pairs) >= 4 and max(r["n"] for r in pairs) < 1_000_000


def test_pairs_only_in_large_orders(spark):
    rows = [(o, p, 1) for o in range(4) for p in range(10)] + [(9, 1, 1), (9, 2, 1)]
    df = spark.createDataFrame(rows, "order_id int, product_id int, quantity int")
    found = {(r[0], r[1]): r[2] for r in basket.pair_counts(df, 3, block=5).collect()}
    assert found == brute_pairs(rows, 3)
    ranked = basket.basket_pairs(df, 3, block=5).orderBy("pair_rank").collect()
    assert [r["pair_rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert (ranked[0]["product_a"], ranked[0]["product_b"], ranked[0]["times_bought_together"]) == (1, 2, 5)


def test_customer_risk_against_sorted_orders(spark):
    """Customer 0 has half of all orders, several on one day; customer 99 has a single one."""
    rng = random.Random(3)
    start = date(2020, 1, 1)
    orders = [(i, 0 if i % 2 else rng.randint(1, 9), start + timedelta(days=rng.randint(0, 900))) for i in range(400)]
    orders += [(1000, 99, start), (1001, None, start)]
    df = spark.createDataFrame(orders, "order_id int, customer_id int, order_date date")
    wanted = {}
    for customer in {c for _, c, _ in orders if c is not None}:
        mine = sorted((d, i) for i, c, d in orders if c == customer)
        gaps = [None] + [(b[0] - a[0]).days for a, b in zip(mine, mine[1:])]
        known = [g for g in gaps if g is not None]
        status = "Insufficient Data" if not known else "At Risk" if sum(known) / len(known) > 30 else "Active"
        wanted.update({i: (gap, status) for (_, i), gap in zip(mine, gaps)})
    got = {r["order_id"]: (r["days_since_previous"], r["risk_status"]) for r in customers.customer_risk(df).collect()}
    assert got == wanted


def test_dedupe_survivor_does_not_depend_on_partitions(spark):
    rows = [(k % 5 if k % 3 else 0, k % 17, f"v{k % 13}") for k in range(600)]
    df = spark.createDataFrame(rows, "k int, at int, v string")
    wanted = {k: min((a, v) for kk, a, v in rows if kk == k) for k in {r[0] for r in rows}}
    for parts in (1, 6):
        kept = dedupe.dedupe_by_key(df.repartition(parts), ["k"], order_by=["at"]).collect()
        assert {r["k"]: (r["at"], r["v"]) for r in kept} == wanted


def test_quarantine_accounts_for_every_row(views):
    orders = clean.clean_orders(views.orders_dirty(), views.as_of())
    products = clean.clean_products(views.products_dirty())
    items = views.items_dirty()
    accepted = clean.clean_order_items(items, orders, products)
    rejected = clean.quarantine_order_items(items, orders, products)
    assert accepted.count() + rejected.agg(F.sum("copies")).first()[0] == items.count()
    reasons = {r[0] for r in rejected.select("reject_reason").distinct().collect()}
    assert {"duplicate", "not_a_number", "zero_quantity", "discount_out_of_range", "unknown_order"} <= reasons
    assert accepted.select("item_id").distinct().count() == accepted.count()


def test_quarantine_reads_the_items_once(spark, tmp_path):
    """Both sides of the survivor join come from one shuffle of merged rows."""
    path = str(tmp_path / "items")
    spark.createDataFrame([("i", "o", "p", "1", "2.00", "0")] * 3, ITEM_TEXTS).write.parquet(path)
    orders = spark.createDataFrame([("o",)], "order_id string")
    products = spark.createDataFrame([("p",)], "product_id string")
    rejected = clean.quarantine_order_items(spark.read.parquet(path), orders, products)
    rejected.collect()
    final = physical(rejected).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 1


def test_quarantine_with_conflicting_copies(spark):
    items = spark.createDataFrame(
        [("i", "o", "p", "1", "2.00", "0")] * 3 + [
            ("i", "o", "p", "2", "2.00", "0"), ("j", "o", "p", "1.5x", "2.00", "0"), ("k", "o", "p", "1.5", "2.00", "0")],
        ITEM_TEXTS)
    orders = spark.createDataFrame([("o",)], "order_id string")
    products = spark.createDataFrame([("p",)], "product_id string")
    rejected = clean.quarantine_order_items(items, orders, products).collect()
    assert sorted((r["item_id"], r["quantity"], r["reject_reason"], r["copies"]) for r in rejected) == [
        ("i", "1", "duplicate", 2), ("i", "2", "duplicate", 1), ("j", "1.5x", "not_a_number", 1)]
    accepted = {r["item_id"]: float(r["quantity"]) for r in clean.clean_order_items(items, orders, products).collect()}
    assert accepted == {"i": 1, "k": 1.5}  # a fraction is a quantity, as in the source


def test_running_revenue_ends_at_the_total(rev):
    runs = sales.running_revenue(rev).groupBy("region_code").agg(
        F.max_by("running_revenue", "order_day").alias("last")).collect()
    totals = rev.groupBy("region_code").agg(F.round(F.sum("net_revenue"), 2).alias("total")).collect()
    assert {r["region_code"]: r["last"] for r in runs} == {r["region_code"]: r["total"] for r in totals}


def test_pareto_and_quartiles(rev):
    last = customers.pareto(rev).agg(F.max("customer_percentile"), F.max("cumulative_revenue_pct")).first()
    assert [float(x) for x in last] == [100.0, 100.0]
    sizes = [r["count"] for r in customers.ltv_quartiles(rev).groupBy("ltv_segment").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_dense_months_fill_gaps(spark):
    rows = [("2020-01", 10), ("2020-03", 5), ("2021-01", 20)]
    df = spark.createDataFrame(rows, "order_month string, net int").withColumn(
        "net_revenue", F.col("net").cast("decimal(18,6)"))
    dense = {r["ym"]: r for r in sales.yoy_growth(df, dense=True).collect()}
    assert len(dense) == 13 and float(dense["2020-02"]["revenue"]) == 0
    assert float(dense["2021-01"]["prev_year_revenue"]) == 10 and float(dense["2021-01"]["yoy_growth_pct"]) == 100
    assert all(r["prev_year_revenue"] is None for r in sales.yoy_growth(df).collect())


def test_previous_window_has_equal_length():
    assert period.previous_window(date(2024, 3, 1), date(2024, 3, 31)) == (date(2024, 1, 30), date(2024, 2, 29))


def test_period_arguments_are_checked(rev):
    with pytest.raises(ValueError, match="unit"):
        period.period_breakdown(rev, "hourly", date(2024, 1, 1), date(2024, 1, 2))
    with pytest.raises(ValueError, match="end"):
        period.period_breakdown(rev, "daily", date(2024, 1, 2), date(2024, 1, 1))


def test_period_without_previous_orders(spark):
    df = spark.createDataFrame([(1, 7, date(2024, 1, 5), 2)], "order_id int, customer_id int, order_date date, n int")
    rows = period.period_comparison(
        df.withColumn("net_revenue", F.col("n").cast("decimal(18,6)")), date(2024, 1, 1), date(2024, 1, 31)).collect()
    assert {r["metric"]: (r["current"], r["previous"], r["change"], r["change_pct"]) for r in rows} == {
        "orders": (1.0, 0.0, "n/a", None), "revenue": (2.0, 0.0, "n/a", None),
        "unique_customers": (1.0, 0.0, "n/a", None)}


def test_upsert_refuses_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(change.DuplicateKeyError):
        change.upsert(target, twice, "k")


def test_upsert_and_its_checks(spark):
    target = spark.createDataFrame([(1, "ORD-1"), (2, "ORD-2")], "k int, v string")
    source = spark.createDataFrame([(2, "ORD-2b"), (3, "INCR-3")], "k int, v string")
    after = change.upsert(target, source, "k")
    assert sorted(map(tuple, after.collect())) == [(1, "ORD-1"), (2, "ORD-2b"), (3, "INCR-3")]
    assert tuple(change.upsert_counts(target, source, "k").first()) == (1, 1)
    report = change.upsert_validation(target, after, source, "k", "v", "INCR-")
    assert {r["check"]: (r["expected"], r["actual"], r["passed"]) for r in report.collect()} == {
        "row_delta": (1, 1, 1), "duplicate_keys": (0, 0, 1), "new_rows_by_prefix": (1, 1, 1)}
    broken = change.upsert_validation(target, target.unionByName(source), source, "k", "v", "INCR-")
    assert {r["check"]: r["passed"] for r in broken.collect()} == {
        "row_delta": 0, "duplicate_keys": 0, "new_rows_by_prefix": 1}
