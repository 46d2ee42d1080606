"""Revisit resolution against loops, and the SQL statements of the corpus queries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from checks import compare
from shelfmark.llm import queries, revisits, sql
from tests.llm.conftest import DATA

RECORD = "record_id long, url string, captured_at long, kind string, digest string, headers map<string,string>"


@pytest.mark.parametrize("name", list(sql.STATEMENTS))
def test_statement(spark, name):
    duck = compare.duckdb_tables(DATA)
    rows = duck.execute(sql.STATEMENTS[name]).fetchall()
    names = [c[0] for c in duck.description]
    df = queries.QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, ([r[c] for c in names] for r in df.collect()))) == sorted(map(str, map(list, rows)))


def test_every_status_occurs(spark):
    found = {r.status: r["count"] for r in queries.op1_revisit_resolution(spark, DATA).groupBy("status").count().collect()}
    assert {"resolved", "etag_mismatch", "modified", "unverifiable", "no_response"} <= set(found)


def test_the_log_has_several_responses_a_url(spark):
    found = queries.op1_revisit_resolution(spark, DATA)
    per_url = found.where("response_id IS NOT NULL").groupBy("canonical_url").agg(F.count_distinct("response_id").alias("n"))
    assert per_url.where("n > 1").count() > 50


@pytest.mark.parametrize("slices", [1, 7, 1000])
def test_as_of_join_matches_loops(spark, slices):
    rng = random.Random(1)
    rows = [(i, rng.choice(["http://A.x/", "https://www.a.x", "http://b.x/p?b=1&a=2", "http://b.x/p?a=2&utm_source=q&b=1#f", None]), rng.choice([rng.randrange(60), None]),
             rng.choice(["response", "revisit", "request"]), str(i), rng.choice([None, {"ETag": rng.choice("uv")}, {"Last-Modified": "m", "Vary": "v"}]))
            for i in range(400)]
    got = {r.record_id: r for r in revisits.resolve_revisits(spark.createDataFrame(rows, RECORD), slices).collect()}
    key = {"http://A.x/": "a.x", "https://www.a.x": "a.x", "http://b.x/p?b=1&a=2": "b.x/p?a=2&b=1", "http://b.x/p?a=2&utm_source=q&b=1#f": "b.x/p?a=2&b=1", None: None}
    visits = [r for r in rows if r[3] == "revisit"]
    assert len(got) == len(visits)
    for i, url, t, _, _, headers in visits:
        row, best = got[i], max(((r[2], r[0], r) for r in rows if r[3] == "response" and t is not None and r[2] is not None
                                 and url and r[1] and key[r[1]] == key[url] and r[2] < t), default=None)
        assert row.canonical_url == key[url] and row.response_id == (best and best[1])
        if best is None:
            assert row.status == "no_response"
            continue
        old, new = best[2][5] or {}, headers or {}
        tags, dates = (new.get("ETag"), old.get("ETag")), (new.get("Last-Modified"), old.get("Last-Modified"))
        want = (("resolved" if tags[0] == tags[1] else "etag_mismatch") if all(tags) else
                ("resolved" if dates[0] == dates[1] else "modified") if all(dates) else "unverifiable")
        assert row.status == want and (row.digest == best[2][4]) == (want == "resolved")


def test_a_hot_url_is_spread_over_slices(spark):
    """A third of all captures are of one URL within a day, another third of one second, and many lack a URL or a time."""
    rows = [(i, "http://hot.x/", i % 86_400, "response" if i % 50 == 0 else "revisit", str(i), {"ETag": "t"}) for i in range(4000)]
    rows += [(10_000 + i, "http://tie.x/", 7, "response" if i % 2 else "revisit", str(i), {"ETag": "t"}) for i in range(4000)]
    rows += [(20_000 + i, None if i % 2 else f"http://u{i}.x/", None if i % 2 == 0 else 5, "revisit", None, None) for i in range(1000)]
    rows += [(30_000, "http://tie.x/", 6, "response", "before", {"ETag": "t"}), (30_001, "http://tie.x/", 8, "revisit", None, {"ETag": "t"})]
    records = spark.createDataFrame(rows, RECORD).repartition(5)
    points = records.where("url IS NOT NULL AND captured_at IS NOT NULL").select(
        F.col("url").alias("canonical_url"), "captured_at").distinct().withColumn("last", F.lit(1))
    slices = points.repartitionByRange(8, "canonical_url", "captured_at").withColumn("slice", F.spark_partition_id())
    hot = slices.where("canonical_url = 'http://hot.x/'").groupBy("slice").count().collect()
    assert len(hot) >= 7 and max(r["count"] for r in hot) < 1500
    got = {r.record_id: r for r in revisits.resolve_revisits(records, 8).collect()}
    assert all(got[i].response_id == (None if i == 0 else (i - 1) // 50 * 50) for i in range(4000) if i % 50)
    assert {got[10_000 + i].response_id for i in range(0, 4000, 2)} == {30_000} and got[30_001].response_id == 13_999
    assert {got[20_000 + i].status for i in range(1000)} == {"no_response"}


def test_clashing_columns_repeated_rows_and_long_urls(spark):
    long_url = "http://h/" + "a" * 200_000 + "?b=" + "c" * 200_000
    rows = [(1, long_url, 5, "response", "d", {"ETag": "x"}), (2, long_url, 9, "revisit", None, {"ETag": "x"}), (2, long_url, 9, "revisit", None, {"ETag": "x"}),
            (3, "", 9, "revisit", None, None), (1, long_url, 5, "response", "d", {"ETag": "x"})]
    records = spark.createDataFrame(rows, RECORD).selectExpr(
        "*", "'q' AS canonical_url", "'q' AS status", "1 AS response_id", "2 AS slice", "3 AS here", "4 AS last", "5 AS r")
    found = revisits.resolve_revisits(records).collect()
    assert sorted((r.record_id, r.response_id, r.status) for r in found) == [(2, 1, "resolved"), (2, 1, "resolved"), (3, None, "no_response")]
    assert {len(r.canonical_url) for r in found if r.record_id == 2} == {len(long_url) - len("http://")}


def test_only_permitted_headers_are_merged(spark):
    rows = [(1, "http://h/", 5, "response", "d", {"ETag": '"x"', "Server": "a", "DATE": "1", "Date": "9", "Content-Type": "t"}),
            (2, "HTTP://H:80", 6, "revisit", None, {"etag": 'W/"x"', "Server": "b", "Date": "2", "Expires": None, "Vary": "v", "Set-Cookie": "c"})]
    row = revisits.resolve_revisits(spark.createDataFrame(rows, RECORD)).first()
    assert row.status == "resolved" and row.headers == {"etag": 'W/"x"', "server": "a", "date": "2", "content-type": "t", "vary": "v"}
    assert revisits.resolve_revisits(spark.createDataFrame([], RECORD)).count() == 0
