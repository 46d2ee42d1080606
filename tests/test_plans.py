"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import registry
from shelfmark.operators import joins, ordering
from shelfmark.plans import customers, facts
from tests.conftest import SMALL, physical


def test_flagship_reads_only_what_it_needs(spark):
    plan = physical(registry.queries()["revenue_by_category"](spark, SMALL))
    items = next(line for line in plan.splitlines() if "l_orderkey" in line and "FileScan" in line)
    assert "l_tax" not in items and "l_shipdate" not in items and "l_suppkey" not in items
    orders = next(line for line in plan.splitlines() if "FileScan" in line and "o_orderstatus" in line)
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders


def test_sums_per_product_come_before_the_product_join(spark):
    """Between the product join and the scan of the lines there is an aggregate per product."""
    plan = physical(registry.queries()["revenue_by_category"](spark, SMALL))
    lines = plan.splitlines()
    product_join = next(i for i, line in enumerate(lines) if "Join [product_id" in line)
    assert any("HashAggregate(keys=[product_id" in line for line in lines[product_join:])


def test_date_range_reaches_the_scan(spark, tmp_path, views):
    from shelfmark.plans import shop
    from shelfmark.sources import files

    files.write_parquet(views.orders(), str(tmp_path / "orders"))
    plan = physical(shop.placed_in_year(files.read_parquet(spark, str(tmp_path / "orders")), 1997))
    assert "GreaterThanOrEqual(order_date,1997-01-01)" in plan and "LessThan(order_date,1998-01-01)" in plan


@pytest.fixture
def small_thresholds(spark):
    """Skew handling as on large data, at test size: no broadcasts, small target partitions."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _final_plan(df):
    df.collect()
    return physical(df).split("== Initial Plan ==")[0]


def _items(spark, hot_share: int):
    """Items of which one order holds one in `hot_share`, spread over several input partitions."""
    order = F.when(F.col("id") % hot_share == 0, F.lit(7)).otherwise(F.col("id") % 900)
    return spark.range(0, 40000, 1, 8).select(
        F.col("id").alias("item_id"), order.alias("order_id"), (F.col("id") % 300).alias("product_id"),
        F.lit(2).alias("quantity"), F.lit("9.99").cast("decimal(12,2)").alias("unit_price"),
        F.lit(5).cast("decimal(5,2)").alias("discount_percent"), F.sha2(F.col("id").cast("string"), 256).alias("note"))


def _orders(spark):
    return spark.range(900).select(
        F.col("id").alias("order_id"), (F.col("id") % 50).alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("order_date"),
        F.lit("SHIPPED").alias("status"), F.lit("WEST").alias("region_code"), F.lit(0).alias("is_guest"))


def test_hot_order_is_split_in_the_line_join(spark, small_thresholds):
    lines = facts.order_lines(_items(spark, 3), _orders(spark))
    assert "skew=true" in _final_plan(lines)
    assert lines.count() == 40000


def test_hot_key_is_split_in_the_outer_joins(spark, small_thresholds):
    people = _orders(spark).select("order_id", F.col("region_code").alias("name"))
    for join in (joins.keep_all_of_one, joins.keep_all_of_many, joins.keep_all):
        joined = join(people, _items(spark, 3).select("order_id", "note"), "order_id")
        assert "skew=true" in _final_plan(joined), join.__name__


def test_hot_customer_days_meet_no_order_window(spark):
    """The window of the order gaps runs above an aggregate per customer and day."""
    lines = physical(customers.customer_risk(_orders(spark))).splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    aggregate = next(i for i, line in enumerate(lines) if "Aggregate(keys=[customer_id" in line)
    assert window < aggregate and "order_date" in lines[aggregate]


# Work that is done once --------------------------------------------------------------------------

def scans(plan: str) -> int:
    return plan.split("== Initial Plan ==")[0].count("FileScan")


def before_checkpoints(monkeypatch, *modules):
    """Make `durable` pass its input on, so that a plan shows what stands before a checkpoint too."""
    for module in modules:
        monkeypatch.setattr(module, "durable", lambda df: df)


def test_best_line_per_customer_reads_the_lines_once(spark):
    plan = physical(registry.queries()["top_order_per_customer_10"](spark, SMALL))
    assert "WindowGroupLimit" in plan and "SortMergeJoin [customer_id" not in plan
    # Once each: lines, orders, customers, nations, regions, parts (some are pruned away).
    assert scans(plan) <= 6


@pytest.mark.parametrize("name", ["top_order_per_customer", "top_order_per_customer_10"])
def test_lines_are_ranked_apart_from_the_joins(spark, name):
    """The first sort by rank reads a shuffle of its own, so it never shares a task's memory with the sorts of the joins."""
    lines = physical(registry.queries()[name](spark, SMALL)).split("== Initial Plan ==")[0].splitlines()
    first = max(i for i, line in enumerate(lines) if "WindowGroupLimit" in line)
    below = next(line for line in lines[first + 1:] if " Sort [" not in line)
    assert "Exchange hashpartitioning(customer_id" in below and "pmod" in "".join(lines[first:first + 4]) and "REPARTITION_BY_COL" in below


def test_best_lines_of_a_large_customer_keep_all_ties(spark):
    """Ties in every share, a customer with lines of no value only, and lines of no customer."""
    kinds = "customer_id int, row_id string, order_id int, sales decimal(12,2)"
    large = spark.range(20000).selectExpr("1 AS customer_id", "concat('r', id) AS row_id", "CAST(id AS INT) AS order_id",
                                          "CAST(IF(id % 400 = 7, 9.5, id % 9) AS DECIMAL(12,2)) AS sales")
    few = spark.createDataFrame([(2, "a", 1, None), (2, "b", 2, None), (None, "c", 3, None), (3, None, 4, None)], kinds)
    one = spark.sql("SELECT 3 AS customer_id, CAST(NULL AS STRING) AS row_id, 5 AS order_id, CAST(-2 AS DECIMAL(12,2)) AS sales")
    best = [(r.customer_id, r.row_id) for r in customers.top_order_per_customer(large.unionByName(few).unionByName(one)).collect()]
    assert sorted(best, key=str) == sorted([(1, f"r{i}") for i in range(7, 20000, 400)] + [(3, None)], key=str)


def test_customer_sums_are_computed_once(spark, monkeypatch):
    """The stored sums are what both the best values and the result read: no scan of a table is left after them."""
    for name in ("top_customers_ranked", "bottom_customers_ranked"):
        assert scans(physical(registry.queries()[name](spark, SMALL))) == 0, name
    stored = []
    durable = ordering.durable
    monkeypatch.setattr(ordering, "durable", lambda df: stored.append(df) or durable(df))
    registry.queries()["top_customers_ranked"](spark, SMALL)
    assert len(stored) == 1


def test_running_sums_take_one_exchange_and_one_sort(spark, monkeypatch):
    """From the input of the checkpoint on: one exchange of the rows, by slice, none by range."""
    before_checkpoints(monkeypatch, ordering)
    df = spark.range(0, 5000, 1, 5).select("id", (F.col("id") % 97).cast("decimal(18,2)").alias("value"))
    plan = physical(ordering.running_sums(df, [ordering.Key("value", descending=True), ordering.Key("id")], ["value"], slices=6))
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(_slice" in line]
    of_rows = [i for i in exchanges if "partial_" not in lines[i + 1]]
    assert len(of_rows) == 1 and "rangepartitioning" not in plan
    # The other exchanges carry a row per slice.
    assert len(exchanges) == 2 and plan.count("Exchange SinglePartition") == 1


def test_period_comparison_multiplies_no_rows(spark):
    assert "Expand" not in physical(registry.queries()["period_comparison"](spark, SMALL))
