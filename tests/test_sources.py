"""Files and tables."""

from __future__ import annotations

import uuid

import pytest

from shelfmark import schemas
from shelfmark.plans import normalise, privacy
from shelfmark.session import fresh_path
from shelfmark.sources import files, tables


def table_name():
    return f"t_{uuid.uuid4().hex}"


def test_csv_keeps_blanks_quotes_nulls_and_leading_zeros(spark, tmp_path):
    rows = [("0409836973", ' "a, b" ', None), ("1", "", "x\\y"), ("2", 'say "hi"', "  ")]
    df = spark.createDataFrame(rows, "phone string, a string, b string")
    files.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), df.schema)
    wanted = [(p, a or None, b) for p, a, b in rows]  # CSV has no empty text: it reads as missing
    assert sorted(map(tuple, back.collect()), key=str) == sorted(wanted, key=str)


def test_csv_bad_lines_are_kept(spark, tmp_path):
    (tmp_path / "in.csv").write_text("order_id,customer_id,product_id,quantity,unit_price,total_amount,order_date,status,"
                                     "payment_method\nO1,C1,P1,two,3.50,7.00,2024-01-02,Paid,Card\n"
                                     "O2,C1,P1,2,3.50,7.00,2024-01-02,Paid,Card\n")
    rows = files.read_csv(spark, str(tmp_path / "in.csv"), schemas.LAKE["orders"], keep_corrupt=True).orderBy("order_id").collect()
    assert rows[0]["quantity"] is None and rows[0]["_corrupt_record"].startswith("O1,C1")
    assert rows[1]["quantity"] == 2 and rows[1]["_corrupt_record"] is None


def test_month_partitions_are_pruned(spark, views, tmp_path):
    orders = views.orders().selectExpr("*", "date_format(order_date, 'yyyy-MM') AS order_month")
    files.write_parquet(orders, str(tmp_path / "o"), ["order_month"])
    one = files.read_parquet(spark, str(tmp_path / "o")).filter("order_month = '1998-05'")
    assert "PartitionFilters: [isnotnull(order_month" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == orders.filter("order_month = '1998-05'").count()


def test_append_is_idempotent(spark):
    name = table_name()
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.save_table(first, name, path=fresh_path(spark, name))
    for _ in range(2):
        tables.append_new_rows(spark.createDataFrame([("c", 3), ("z", 1)], "v string, k int"), name, "k")
    assert sorted(map(tuple, tables.read_table(spark, name).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_replace_table_from_its_own_rows(spark):
    name, folder = table_name(), fresh_path(spark, "versions")
    tables.replace_table(spark.createDataFrame([(1,), (1,), (2,)], "k int"), name, folder)
    tables.replace_table(tables.read_table(spark, name).distinct(), name, folder)
    assert sorted(r[0] for r in tables.read_table(spark, name).collect()) == [1, 2]
    tables.drop_table(spark, name)


def test_bucketed_tables_join_without_shuffle(spark, views):
    items, orders = table_name(), table_name()
    tables.save_table(views.items(), items, fresh_path(spark, items), bucket_by=(4, "order_id"))
    tables.save_table(views.orders(), orders, fresh_path(spark, orders), bucket_by=(4, "order_id"))
    joined = spark.table(items).hint("merge").join(spark.table(orders), "order_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == views.items().count()
    for name in (items, orders):
        tables.drop_table(spark, name)


def test_positional_rename_checks_the_width(spark):
    with pytest.raises(ValueError, match="2 columns"):
        normalise.rename_positional(spark.createDataFrame([(1, 2)], "a int, b int"), ["x"])
    assert len(schemas.SUPERSTORE.names) == 22


def test_silver_has_no_identity(spark, views):
    from pyspark.sql import functions as F

    people = privacy.mask_customers(views.customers(), F.lit("2004-06-15").cast("date"))
    orders = privacy.tokenize_orders(views.lake_orders())
    payments = privacy.mask_payments(views.payments())
    for df in (people, orders):
        assert not {"customer_id", "dob"} & set(df.columns)
    assert "cvv" not in payments.columns
    assert people.filter(~F.col("customer_name").endswith("***")).count() == 0
    assert payments.filter(~F.col("card_number").startswith("************")).count() == 0
    by_id = views.lake_orders().join(views.customers(), "customer_id").count()
    assert orders.join(people, "customer_token").count() == by_id
