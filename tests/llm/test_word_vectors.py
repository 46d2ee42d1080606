"""Quality scores from random-indexing vectors: parts against loops, the whole by held-out accuracy."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfmark.llm import queries, wordvectors as wv
from tests.llm.conftest import DATA


def test_context_sums_match_loops():
    texts = [b"The dog, the DOG!! ran", b"", b"one", b"a b a b a b c", b"Stra\xc3\x9fe 12 \xc3\xa9t\xc3\xa9 ... --"]
    units, index = wv.Units(), wv.index_vectors()
    assert (np.abs(index).sum(1) <= wv.NONZERO).all() and index.any(1).mean() > 0.9
    table = np.zeros((wv.ROWS, wv.DIMENSION), np.int64)
    for coded, owner in wv.pieces(texts, units):
        wv.add_contexts(table, coded, owner, index)
    expected = defaultdict(lambda: np.zeros(wv.DIMENSION, np.int64))
    for text in texts:
        coded = wv.Units().of(text.split())
        for i, own in enumerate(coded):
            for j in range(max(0, i - wv.REACH), min(len(coded), i + wv.REACH + 1)):
                if j != i:
                    for unit in own:
                        expected[int(unit)] += index[coded[j][0]].astype(int) + index[coded[j][1]]
    assert {u for u in np.flatnonzero(table.any(1))} == {u for u, v in expected.items() if v.any()}
    assert all((table[u] == v).all() for u, v in expected.items())


def test_units_put_forms_and_shapes_together():
    units = wv.Units().of([b"Dog", b"(dog)", b"dog!!", b"cat!!", b"DOG"])
    assert len(set(units[[0, 1, 2, 4], 0])) == 1 and units[3, 0] != units[0, 0]
    assert units[2, 1] == units[3, 1] and len({units[0, 1], units[2, 1], units[4, 1]}) == 3


def test_counts_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} x y{i % 3}, Zed") for i in range(200)], "doc_id long, text string")
    tables = [wv.count_contexts(docs.repartition(n)) for n in (1, 6)]
    assert (tables[0] == tables[1]).all() and tables[0].any()


def test_pooling_matches_loops_and_long_texts_come_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.2, (wv.ROWS, wv.DIMENSION))
    texts = [b"", b"a", b" ".join(b"w%d" % rng.integers(30) for _ in range(5000)), b"x x y"]
    got = wv.pooled(texts, vectors, wv.Units())
    for text, row in zip(texts, got):
        words = text.split()
        if not words:
            assert not row.any()
            continue
        x = np.array([np.concatenate([vectors[a], vectors[b]]) for a, b in wv.Units().of(words)], np.float64)
        wanted = [*x.mean(0), *x.std(0), np.log1p(len(words)), len(set(words)) / len(words)]
        assert np.allclose(row, wanted, atol=1e-6)
    monkeypatch.setattr(wv, "WORDS_AT_ONCE", 64)
    assert np.allclose(wv.pooled(texts, vectors, wv.Units()), got, atol=1e-6)


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(9, 4 * wv.DIMENSION + 2)), rng.integers(0, 2, 9)
    y[:2] = 0, 1
    net = wv.fit(x, y, seed=1)
    net.first_bias = rng.normal(size=wv.HIDDEN)

    def loss():
        z = net.logits(x)
        return np.mean(np.logaddexp(0, np.where(y == 1, -z, z)))

    for name, grad in zip(wv.PARAMETERS, net.gradients(x, y)):
        value = np.atleast_1d(np.array(getattr(net, name), float))
        for at in list(np.ndindex(value.shape))[::max(1, value.size // 7)]:
            ends = []
            for move in (1e-5, -1e-5):
                moved = value.copy()
                moved[at] += move
                setattr(net, name, moved if np.ndim(grad) else float(moved[0]))
                ends.append(loss())
            setattr(net, name, value if np.ndim(grad) else float(value[0]))
            assert np.isclose((ends[0] - ends[1]) / 2e-5, np.atleast_1d(grad)[at], atol=1e-6)


def test_temperature_is_the_one_of_least_cross_entropy():
    rng = np.random.default_rng(3)
    z = rng.normal(0, 2, 20_000)
    y = rng.random(len(z)) < 1 / (1 + np.exp(-z))
    counts = np.zeros((2, 2 * wv.FARTHEST * wv.STEPS), np.int64)
    np.add.at(counts, (y.astype(int), ((3 * z + wv.FARTHEST) * wv.STEPS).astype(int)), 1)
    assert wv.best_temperature(counts) == pytest.approx(3, rel=0.08)
    counts[0] = 0
    assert wv.best_temperature(counts) == 1


def test_held_out_accuracy(spark, documents):
    rows = {r.doc_id: r for r in queries.op11_random_indexing(spark, DATA).collect()}
    assert set(rows) == {d for d, _ in documents} and all(0 <= r.score <= 1 for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    tested = [(rows[d].score, q) for d, q in labels.items() if d in rows and rows[d].held_out]
    good, bad = ([s for s, q in tested if q == k] for k in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([s >= 0.3 for s in good]) > 0.97 and np.mean([s < 0.3 for s in bad]) > 0.8


def test_held_out_labels_and_metadata_do_not_matter(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.withColumn("quality", (1 - labels["quality"]).cast("long")).where(wv.held_out(labels["doc_id"]))
    known = labels.where(~wv.held_out(labels["doc_id"]))
    changed = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source", "0L AS n_chars")
    scores = [{r.doc_id: round(r.score, 6) for r in wv.score_quality(d, x).collect()}
              for d, x in ((docs, labels), (changed, known.unionByName(turned)))]
    assert scores[0] == scores[1]


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (5, 1), (5, 1), (7, None), (None, 1), (7, 3)], "doc_id long, quality int")
    assert {r.doc_id: r.quality for r in wv.usable(labels).collect()}.get(3, 0) == 0
    rows = wv.score_quality(awkward, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in awkward.collect())
    assert len({r.score for r in rows if r.doc_id in (1, 2, 4)}) == 1 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert {r.score for r in wv.score_quality(awkward, labels.where("quality > 5")).collect()} == {0.5}
    assert wv.score_quality(nothing, labels).collect() == []
