"""Column functions against worked examples."""

from __future__ import annotations

import hashlib
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import dates, money, text


def values(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_name_case_after_space(spark):
    names = ["  FICTION SEEK  ", "T-Shirt", "o'neil 3d", None]
    assert values(spark, names, text.name_case) == ["Fiction Seek", "T-shirt", "O'neil 3d", None]


def test_name_case_after_non_letter(spark):
    names = ["  FICTION SEEK  ", "t-shirt", "o'NEIL 3d", "élan vital", "a  b", "x.y-z", None]
    wanted = [None if n is None else n.strip().title() for n in names]
    assert values(spark, names, lambda c: text.name_case(c, "non_letter")) == wanted


def test_name_case_rejects_unknown_mode(spark):
    with pytest.raises(ValueError, match="after must be"):
        text.name_case(F.lit("x"), "comma")


def test_phone(spark):
    phones = ["0409836973", "409-836 9731", None]
    assert values(spark, phones, text.format_phone) == ["(040) 983-6973", "(409) 836-9731", None]


def test_masks(spark):
    assert values(spark, ["Patrick Duran"], text.keep_first) == ["P***"]
    assert values(spark, ["ortegamatthew@example.org"], text.mask_email) == ["o***@example.org"]
    assert values(spark, ["(930) 417-7541"], text.mask_phone) == ["(XXX) XXX-7541"]
    assert values(spark, ["099 Patterson Station"], text.mask_address) == ["*** Station"]
    assert values(spark, ["4111111111116075"], text.mask_card) == ["************6075"]


def test_token_with_and_without_secret(spark):
    plain = hashlib.sha256(b"CUS000895").hexdigest()
    salted = hashlib.sha256(b"pepperCUS000895").hexdigest()
    assert values(spark, ["CUS000895"], text.token) == [plain]
    assert values(spark, ["CUS000895"], lambda c: text.token(c, "pepper")) == [salted]


def test_email_rules_differ(spark):
    mails = ["a@b.org", "a@b", "no-at.org", "a@b@c.d", "x y@b.org", None]
    assert values(spark, mails, text.email_flag) == [1, 0, 0, 1, 1, 0]
    assert values(spark, mails, text.email_strict) == [True, False, False, False, False, False]
    assert values(spark, mails, text.email_has_at) == [True, True, False, True, True, None]


def test_null_tokens(spark):
    assert values(spark, ["", "NULL", "None", "nan", "C1", None], text.blank_to_null) == [None] * 4 + ["C1", None]


def test_tier_keeps_null(spark):
    bands = [(25, "18-24"), (35, "25-34")]
    assert values(spark, [17, 25, 60, None], lambda c: text.tier(c, bands, "35+"), "int") == [
        "18-24", "25-34", "35+", None]


def test_mixed_dates(spark):
    texts = ["2024-03-07", "07-03-2024", " 2024-3-7 ", "bad-date", "2024-13-01", "", None, "3/7/2024"]
    day = date(2024, 3, 7)
    assert values(spark, texts, dates.parse_mixed_date) == [day, day, day, None, None, None, None, None]


def test_us_dates(spark):
    assert values(spark, ["3/7/2024", "12/31/1999", "x"], dates.parse_us_date) == [
        date(2024, 3, 7), date(1999, 12, 31), None]


def test_week_key_over_several_years(spark):
    days = [date(1995, 1, 1) + timedelta(days=n) for n in range(3000)]
    assert values(spark, days, dates.week_key, "date") == [d.strftime("%Y-%W") for d in days]


def test_age(spark):
    born = [date(1980, 6, 16), date(1980, 6, 15), None]
    assert values(spark, born, lambda c: dates.age_in_years(c, F.lit(date(2004, 6, 15))), "date") == [23, 24, None]


def test_rounding_is_exact(spark):
    """10.015 has no exact DOUBLE; the mean of 10.01 and 10.02 still rounds up."""
    df = spark.createDataFrame([(Decimal("10.01"),), (Decimal("10.02"),)], "x decimal(12,2)")
    assert df.agg(money.average(F.col("x"))).first()[0] == Decimal("10.02")


def test_ratio_over_zero_is_null(spark):
    assert spark.range(1).select(money.ratio(F.lit(1), F.lit(0), 2)).first()[0] is None


def test_percent_change(spark):
    df = spark.createDataFrame([(150.0, 100.0), (97.0, 100.0), (5.0, 0.0)], "c double, p double")
    shown = df.select(money.percent_change_text(F.col("c"), F.col("p")), money.percent_change(F.col("c"), F.col("p")))
    assert [tuple(r) for r in shown.collect()] == [("50.0%", 50.0), ("-3.0%", -3.0), ("n/a", None)]
