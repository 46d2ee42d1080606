"""Layers from raw files to marts, the store clean-up, and the incremental load."""

from __future__ import annotations

import os
import uuid
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import change
from shelfmark.plans import facts, layers, marts, period
from shelfmark.session import fresh_path
from shelfmark.sources import files, tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lakehouse_from_raw_to_gold(spark, views, tmp_path):
    as_of = F.lit("2004-06-15").cast("date")
    raw = {
        "customers": views.customers_dirty(), "products": views.products(),
        "orders": views.lake_orders().unionByName(views.lake_orders().limit(20)), "payments": views.payments(),
    }
    layers.write_layer(layers.clean_lake(raw), str(tmp_path / "clean"))
    cleaned = layers.read_layer(spark, str(tmp_path / "clean"), raw)
    assert cleaned["orders"].count() == views.lake_orders().select("order_id").distinct().count()
    silver = layers.silver_lake(cleaned, as_of)
    layers.write_layer(silver, str(tmp_path / "silver"))
    stored = layers.read_layer(spark, str(tmp_path / "silver"), silver)
    assert not any({"customer_id", "dob", "cvv"} & set(df.columns) for df in stored.values())
    gold = layers.gold_lake(stored)
    orders, products = stored["orders_clean"], stored["products_clean"]
    assert rows(gold["product_summary"]) == rows(marts.product_summary(orders, products))
    assert rows(gold["category_revenue"]) == rows(marts.category_revenue(orders, products))
    assert set(gold) == {"sales_summary", "customer_summary", "product_summary", "category_revenue", "monthly_revenue"}
    total = orders.agg(F.sum("total_amount")).first()[0]
    assert gold["monthly_revenue"].agg(F.sum("monthly_revenue")).first()[0] == total


def silver_of(spark, tokens):
    """A silver layer with two orders per token and product, one of them without an amount."""
    kinds = "order_id string, product_id int, customer_token string, quantity int, total_amount decimal(12,2), order_date date, status string"
    orders = [(f"{token}-{product}-{i}", product, token, 2, None if i else "9.99", date(2001, 1 + n % 2, 3) if n else None, "PLACED")
              for n, token in enumerate(tokens) for product in (1, 2, None) for i in (0, 1)]
    orders = [(*r[:4], r[4] and Decimal(r[4]), *r[5:]) for r in orders]
    return {
        "orders_clean": spark.createDataFrame(orders, kinds),
        "products_clean": spark.createDataFrame([(1, "a", "A"), (2, "b", "A")], "product_id int, product_name string, category string"),
        "customers_secure": spark.createDataFrame([(t, "18-24", "c", "s") for t in tokens if t is not None],
                                                  "customer_token string, age_band string, city string, state string"),
    }


def stored_silver(spark, path):
    layers.write_layer(silver_of(spark, ["ab12", "AB12"]), path)
    return layers.read_layer(spark, path, ["orders_clean", "products_clean", "customers_secure"])


def test_customer_mart_reads_no_orders_again(spark, tmp_path):
    gold = layers.gold_lake(stored_silver(spark, str(tmp_path / "silver")))
    read = gold["customer_summary"].inputFiles()
    assert any("customers_secure" in f for f in read) and not any("orders_clean" in f for f in read)


def test_monthly_mart_reads_no_orders_again(spark, tmp_path):
    gold = layers.gold_lake(stored_silver(spark, str(tmp_path / "silver")))
    assert not any("orders_clean" in f for f in gold["monthly_revenue"].inputFiles())


def test_sums_keep_orders_without_a_month(spark):
    silver = silver_of(spark, ["a1", "b2", "c3", None])
    got, orders = layers.gold_lake(silver)["monthly_revenue"], silver["orders_clean"]
    wanted = marts.monthly_revenue(orders)
    assert rows(got) == rows(wanted) and {r.order_month for r in got.collect()} == {None, "2001-01", "2001-02"}
    assert got.dtypes == wanted.dtypes


def test_sums_keep_any_token_and_missing_keys(spark):
    """Lower-case hexadecimal, other spellings of it, no hexadecimal, an odd number of digits, empty, missing."""
    silver = silver_of(spark, ["ab12", "AB12", "aB12", "ab1", "0ab1", "token", "", " ", None])
    gold, orders = layers.gold_lake(silver), silver["orders_clean"]
    assert rows(gold["customer_summary"]) == rows(marts.customer_summary(orders, silver["customers_secure"]))
    assert gold["customer_summary"].count() == 8
    assert rows(gold["sales_summary"]) == rows(marts.sales_summary(orders, silver["products_clean"]))
    assert gold["customer_summary"].schema == marts.customer_summary(orders, silver["customers_secure"]).schema


def test_marts_can_leave_statuses_out(views):
    orders = views.lake_orders()
    without = marts.monthly_revenue(orders, exclude=["CANCELLED"]).agg(F.sum("monthly_revenue")).first()[0]
    assert without == orders.filter("status <> 'CANCELLED'").agg(F.sum("total_amount")).first()[0]


def test_store_clean_up_and_report(views):
    raw = {"customers": views.customers_dirty(), "products": views.products_dirty(),
           "orders": views.orders_dirty(), "order_items": views.items_dirty()}
    cleaned = layers.clean_store(raw, views.as_of())
    items = cleaned["order_items"].count()
    assert items + cleaned["rejected_items"].agg(F.sum("copies")).first()[0] == raw["order_items"].count()
    rev = facts.revenue_lines(facts.order_lines(cleaned["order_items"], cleaned["orders"]))
    report = period.period_report(rev, cleaned["products"], "monthly", date(1998, 1, 1), date(1998, 6, 30))
    assert report["breakdown"].count() == 6 and report["top_products"].count() == 3
    summary = {r["metric"]: r["current"] for r in report["summary"].collect()}
    assert summary["revenue"] == pytest.approx(float(report["breakdown"].agg(F.sum("revenue")).first()[0]))


def test_incremental_load(spark, views):
    name, folder = f"master_{uuid.uuid4().hex}", fresh_path(spark, "master")
    target = views.upsert_target()
    tables.replace_table(target.unionByName(target.limit(10)), name, folder)
    layers.remove_duplicates(spark, name, "order_id", folder)
    assert tables.read_table(spark, name).count() == target.count()
    report = layers.incremental_load(views.upsert_source(), name, "order_id", folder, "order_code", "INCR-2001")
    assert {r["check"]: r["passed"] for r in report.collect()} == {
        "row_delta": 1, "duplicate_keys": 1, "new_rows_by_prefix": 1}
    assert rows(tables.read_table(spark, name)) == rows(change.upsert(target, views.upsert_source(), "order_id"))
    tables.drop_table(spark, name)


def test_partitioned_upsert_rewrites_only_what_changed(spark, views, tmp_path):
    path = str(tmp_path / "orders")
    month = F.date_format("order_date", "yyyy-MM")
    files.write_parquet(views.upsert_target().withColumn("month", month), path, ["month"])
    old = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("month=")}
    change.upsert_partitions(path, views.upsert_source().withColumn("month", month), "order_id", "month")
    new = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("month=")}
    touched = {d for d in new if old.get(d) != new[d]}
    assert touched == {d for d in new if d >= "month=2000-10"} and len(new) > len(old)
    stored = files.read_parquet(spark, path).drop("month")
    assert rows(stored) == rows(change.upsert(views.upsert_target(), views.upsert_source(), "order_id"))


def test_partitioned_upsert_refuses_to_move_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2")], "k int, v string, m string"), path, ["m"])
    with pytest.raises(change.MovedKeyError):
        change.upsert_partitions(path, spark.createDataFrame([(1, "c", "m2")], "k int, v string, m string"), "k", "m")
