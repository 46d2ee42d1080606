"""Rows on their way in: exact numbers, checked scans, judged batches, pruned upserts."""

from __future__ import annotations

import random
import re
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.numbers import exact_number, number_fault
from shelfmark.operators import change
from shelfmark.operators.quality import Reference, judge_batch
from shelfmark.plans import clean, facts
from shelfmark.session import fresh_path
from shelfmark.sources import files, tables
from tests.conftest import physical

BLANK = r"[ \t\n\x0B\f\r]*"


def spelled(text: str | None, whole: int, places: int):
    """The value and the fault of a text, from the definition."""
    if text is None or not re.fullmatch(rf"{BLANK}[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?{BLANK}", text):
        return None, "not_a_number"
    if "e" in text.lower() and not re.fullmatch(rf"{BLANK}[+-]?[0-9]*\.?[0-9]{{0,9}}[eE][+-]?0*[0-9]{BLANK}", text):
        return None, "does_not_fit"
    number = D(text.strip())
    if number == 0:
        return D(0), None
    digits, exponent = list(number.as_tuple().digits), number.as_tuple().exponent
    while digits[-1] == 0:
        digits.pop()
        exponent += 1
    return (None, "does_not_fit") if -exponent > places or len(digits) + exponent > whole else (number, None)


@pytest.mark.parametrize("whole, places", [(8, 6), (3, 6), (19, 0), (1, 1), (0, 2)])
def test_numbers_are_exact_or_told_apart(spark, whole, places):
    rng = random.Random(1)
    texts = ["1", "01.50", " 7 ", "1e2", "-0.001", "+5.", "  .5", "5.555", "1.0000000", "1.00000001", "99999999", "1e8", "10e-7", "0e99",
             "", " ", ".", "-", "e5", "1e", "nan", "inf", "1,5", "0x1", "1_0", "٣", "--1", "1e999999999", "\t2\n", None, "1" * 40,
             "0" * 30 + "2", "1." + "0" * 18, "1." + "0" * 19, "0.05", "-.00", "9" * 19, "1e-9", "1e-10"]
    for _ in range(600):
        texts.append("".join(rng.choice("0012345 .eE+-") for _ in range(rng.randrange(1, 9))))
        texts.append(f"{rng.choice(['', '-', '+'])}{rng.randrange(10 ** rng.randrange(1, 11))}{rng.choice(['', '.'])}"
                     f"{rng.randrange(10 ** rng.randrange(1, 9))}{rng.choice(['', f'e{rng.randrange(-9, 10)}'])}")
    read = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("n", exact_number(F.col("t"), whole, places))
    got = {r.i: (r.n, r.f) for r in read.withColumn("f", number_fault(F.col("t"), F.col("n"))).collect()}
    assert [(t, got[i]) for i, t in enumerate(texts)] == [(t, spelled(t, whole, places)) for t in texts]


def test_item_rules_see_unrounded_values(spark):
    rows = [("a", "2.00004", "1.239", "0"), ("b", "2.5", "5.555", "12.3456"), ("c", "1", "0.004", "100"), ("d", "1", "1", "-0.001"),
            ("e", "1", "1", "100.004"), ("f", "0.0000001", "1", "0"), ("g", "1", "-0.004", "0"), ("h", "0.000000", "1", "0"),
            ("i", "nan", "0.0000001", "0"), ("j", None, "1", "0"), ("k", "1e1", " 7 ", "5")]
    items = spark.createDataFrame(rows, "item_id string, quantity string, unit_price string, discount_percent string")
    judged = {r.item_id: r for r in clean.judged_items(items).collect()}
    assert {k: r.fault for k, r in judged.items()} == {
        "a": None, "b": None, "c": None, "d": "discount_out_of_range", "e": "discount_out_of_range", "f": "does_not_fit",
        "g": "non_positive_price", "h": "zero_quantity", "i": "not_a_number", "j": "not_a_number", "k": None}
    assert (judged["a"].quantity, judged["a"].unit_price, judged["b"].quantity) == (D("2.00004"), D("1.239"), D("2.5"))


def test_line_value_is_rounded_once(spark):
    items = spark.createDataFrame([("a", 1, 1, D("2.00004"), D("1.239"), D("12.3456"))], "item_id string, order_id long, product_id long, "
                                  "quantity decimal(14,6), unit_price decimal(14,6), discount_percent decimal(9,6)")
    orders = spark.createDataFrame([(1, 1, "SHIPPED", "WEST", 0)], "order_id long, customer_id long, status string, region_code string, "
                                   "is_guest int").withColumn("order_date", F.lit("2020-01-01").cast("date"))
    net = facts.order_lines(items, orders).first()["net_revenue"]
    assert net == (D("2.00004") * D("1.239") * (100 - D("12.3456")) / 100).quantize(D("0.000001"))


# Checked scans

ORDER = schemas.LAKE["orders"]
LINES = [
    "O1,C1,P1,2,3.50,7.00,2024-01-02,Paid,Card", "O2,C1,P1,2,3.50,7.00,2024-01-02,Paid,", ",C1,P1,2,3.50,7.00,2024-01-02,Paid,Card",
    "O4,C1,P1,2.5,3.50,7.00,2024-01-02,Paid,Card", "O5,C1,P1,2,3.555,7.00,02/01/2024,Paid,Card", "O6,C1,P1,2,3.50,7.00,2024-01-02,Paid",
    "O7,C1,P1,2,3.50,7.00,2024-01-02,Paid,Card,extra", "O8,C1,P1,99999999999,3.50,x,2024-02-30,Paid,Card", "O9", 'O10,"C,1",P1, 2 ,3.50,7,2024-01-02,Paid,Card',
]


@pytest.mark.parametrize("header", [True, False])
def test_scan_tells_good_rows_from_broken_ones(spark, tmp_path, header):
    (tmp_path / "in.csv").write_text("\n".join([",".join(ORDER.names)] * header + LINES) + "\n")
    checked = files.scan_checked(spark, str(tmp_path / "in.csv"), ORDER, header)
    good = files.good_rows(checked)
    assert [(f.name, f.dataType) for f in good.schema.fields] == [(f.name, f.dataType) for f in ORDER.fields]
    assert sorted((r.order_id, r.customer_id, r.quantity, r.payment_method) for r in good.collect()) == [
        ("O1", "C1", 2, "Card"), ("O10", "C,1", 2, "Card"), ("O2", "C1", 2, None)]
    rejected = files.rejected_lines(checked).collect()
    assert {r.order_id: r.reject_reasons for r in rejected} == {
        None: ["missing:order_id"], "O4": ["does_not_fit:quantity"], "O5": ["does_not_fit:unit_price", "malformed:order_date"],
        "O6": ["malformed_line"], "O7": ["malformed_line"], "O9": ["malformed_line"],
        "O8": ["does_not_fit:quantity", "not_a_number:total_amount", "malformed:order_date"]}
    assert {r._corrupt_record for r in rejected} == {None, LINES[5], LINES[6], LINES[8]}
    # Whichever columns are read, the same lines are broken.
    assert files.good_rows(checked).select("payment_method").count() == 3


def test_scan_lands_from_one_reading(spark, tmp_path):
    (tmp_path / "in.csv").write_text("\n".join(LINES) + "\n")
    files.land_checked(spark, str(tmp_path / "in.csv"), ORDER, str(tmp_path / "good"), str(tmp_path / "bad"), header=False)
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3 and spark.read.parquet(str(tmp_path / "bad")).count() == len(LINES) - 3
    plan = physical(files.scan_checked(spark, str(tmp_path / "in.csv"), ORDER, header=False))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


# Batches

def test_batch_is_accounted_for_row_by_row(spark):
    known = spark.createDataFrame([(1, "old", 1)], "k int, v string, p int")
    parents = spark.createDataFrame([(1,), (2,), (2,)], "p int")
    rows = [(1, "a", 1), (2, "c", 1), (2, "c", 1), (2, "b", 9), (2, "d", 2), (None, "e", 1), (None, "e", 1), (3, "f", None), (4, "g", 9),
            (None, None, 9), (5, None, 2), (5, "z", 2)]
    batch = spark.createDataFrame(rows, known.schema)
    judged = judge_batch(batch, known, "k", [Reference("p", parents, "p")]).collect()
    assert Counter((r.k, r.v, r.p) for r in judged for _ in range(r.copies)) == Counter(rows)
    assert Counter((r.k, r.v, r.reject_reason, r.copies) for r in judged) == Counter([
        (1, "a", "known_key", 1), (2, "c", None, 1), (2, "c", "repeated_key", 1), (2, "b", "unknown_p", 1), (2, "d", "repeated_key", 1),
        (None, "e", "missing_key", 2), (3, "f", None, 1), (4, "g", "unknown_p", 1), (None, None, "missing_key", 1), (5, None, None, 1),
        (5, "z", "repeated_key", 1)])


def test_append_gives_its_rejects_back(spark):
    name = "append_rejects"
    tables.drop_table(spark, name)
    tables.save_table(spark.createDataFrame([(1, "a")], "k int, v string"), name, path=fresh_path(spark, name))
    batch = spark.createDataFrame([("b", 2), ("b", 2), ("x", None), ("y", 1)], "v string, k int")
    first = tables.append_new_rows(batch, name, "k")
    assert sorted((r.k or 0, r.reject_reason, r.copies) for r in first.collect()) == [
        (0, "missing_key", 1), (1, "known_key", 1), (2, "repeated_key", 1)]
    second = tables.append_new_rows(batch, name, "k")
    assert second.agg(F.sum("copies")).first()[0] == 4 and spark.table(name).count() == 2
    assert first.count() == 3  # as judged then, though the table holds key 2 by now
    assert tables.append_new_rows(batch.limit(0), name, "k").count() == 0
    tables.drop_table(spark, name)


# Upserts

ROW = "k int, v string, m string"


def test_upsert_scans_only_the_partitions_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, "a", f"m{i % 5}" if i % 5 else None) for i in range(50)], ROW).write.partitionBy("m").parquet(path)
    target = spark.read.parquet(path)
    for values in (["m1", "m2"], ["m1", None], [None]):
        part = change.within_partitions(target, "m", values)
        scan = next(line for line in physical(part).splitlines() if "PartitionFilters" in line)
        assert "PartitionFilters: []" not in scan and "PartitionFilters: [" in scan
        files_read = part.select(F.input_file_name().alias("f")).distinct().collect()
        assert {re.search(r"m=([^/]+)", r.f)[1] for r in files_read} == {v or "__HIVE_DEFAULT_PARTITION__" for v in values}
        part.collect()


@pytest.mark.parametrize("at_once", [1, 2, 100])
def test_upsert_in_batches_of_partitions(spark, tmp_path, at_once):
    path = str(tmp_path / "t")
    rows = [(i, "a", f"m{i % 5}" if i % 5 else None) for i in range(50)]
    spark.createDataFrame(rows, ROW).write.partitionBy("m").parquet(path)
    source = [(0, "A", None), (1, "A", "m2"), (2, "A", "m2"), (6, "A", "m1"), (99, "A", "m9")]  # 1 moves between two touched ones
    assert change.upsert_partitions(path, spark.createDataFrame(source, ROW), "k", "m", at_once) == -(-4 // at_once)
    got = {r.k: (r.v, r.m) for r in spark.read.parquet(path).collect()}
    assert got == {**{k: (v, m) for k, v, m in rows}, **{k: (v, m) for k, v, m in source}}
    assert spark.read.parquet(path).count() == 51


def test_the_whole_table_is_read_for_its_keys_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2")], ROW).write.partitionBy("m").parquet(path)
    plans = []
    empty = type(spark.range(0)).isEmpty
    monkeypatch.setattr(type(spark.range(0)), "isEmpty", lambda df: plans.append(physical(df)) or empty(df))
    change.upsert_partitions(path, spark.createDataFrame([(1, "A", "m1")], ROW), "k", "m")
    whole = [line for line in plans[-1].splitlines() if "FileScan" in line and "PartitionFilters: []" in line]
    assert whole and all("ReadSchema: struct<k:int>" in line or "ReadSchema: struct<>" in line for line in whole)


def test_upsert_refuses_rows_without_a_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    for bad, error in (([(None, "x")], change.MissingKeyError), ([(None, "x"), (None, "y")], change.MissingKeyError),
                       ([(1, "x"), (1, "y")], change.DuplicateKeyError)):
        with pytest.raises(error):
            change.upsert(target, spark.createDataFrame(bad, target.schema), "k")
