"""The pipeline, stage by stage, against brute force on what each stage was given."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np

import __spark_entry__
import corpus_pipeline
from shelfmark.llm import quality
from tests.llm.conftest import DATA
from tests.llm.test_matching import brute_components, plain
from tests.llm.test_row_operators import brute_spans, brute_statistics


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    start, columns = rows_of(docs), docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "decontamination", "secret scans", "packing"]
    (_, rules), (_, dedup), (_, decontaminate), (_, scan), (_, pack) = corpus_pipeline.STAGES

    good = rules(spark, docs, DATA).cache()
    judged = {r.doc_id: r.kept for r in quality.judge_quality(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect()}
    kept = rows_of(good)
    assert good.columns == columns and set(kept) == {d for d, k in judged.items() if k} and all(kept[d] == start[d] for d in kept)
    assert all(brute_statistics(r.text)[0] >= 50 for r in kept.values()) and 500 < len(kept) < len(start)

    single = dedup(spark, good, DATA).cache()
    groups = brute_components([(d, r.text) for d, r in kept.items()], 5)
    assert single.columns == columns and set(rows_of(single)) == {d for d, (_, c) in groups.items() if d == c}

    clean = decontaminate(spark, single, DATA).cache()
    items = ["\x00".join(["", *plain(r.text), ""]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    leaks = {d for d, r in rows_of(single).items() if any(i in "\x00".join(["", *plain(r.text), ""]) for i in items)}
    left = rows_of(clean)
    assert clean.columns == columns and leaks and not leaks & set(left) and len(left) >= single.count() - len(leaks) - 2

    masked = rows_of(scan(spark, clean, DATA))
    assert set(masked) == set(left)
    for d, r in masked.items():
        if not brute_spans(left[d].text):
            assert r.text == left[d].text
        else:
            assert "[secret]" in r.text and not brute_spans(r.text) and r.n_chars == len(r.text)

    packed = pack(spark, scan(spark, clean, DATA), DATA).collect()
    assert {p.doc_id for p in packed} == set(left)
    used = Counter()
    for p in packed:
        used[p.sequence_id] += p.length
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
    assert max(used.values()) <= 1024


def test_run_applies_all_stages(spark):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    step = lambda df: sorted((p.doc_id, p.start, p.ids_crc32) for p in df.collect())
    assert step(__spark_entry__.queries()["pipeline"](spark, small)) == step(docs)


def test_stages_take_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0) == (docs is awkward)


def test_entry_lists_every_operator():
    names = [re.match(r"op(\d+)_", n) for n in __spark_entry__.queries()]
    assert sorted(int(m[1]) for m in names if m) == list(range(1, 14))
