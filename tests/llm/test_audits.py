"""The divergence audit and the Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import divergence, merkle, queries
from tests.llm.conftest import DATA, DOCS

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return [r.asDict() for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


# divergence

def brute_divergence(rows, least, top):
    count, found, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        groups[lang].add(source)
        terms = [t.translate(LOWER) for t in TERM.findall(r["text"] or "")]
        count[lang, source].update(terms)
        found[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in found[lang].items() if n >= least]

        def frequencies(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = frequencies(sum((count[lang, s] for s in sources), Counter()))
        p = {s: frequencies(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - whole[t], t) for t in kept if count[lang, s][t] and p[s][t] > whole[t]]
            for part, values, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(values, key=lambda v: (-v[0], v[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def found_by(df, **options):
    return sorted(tuple(r) for r in divergence.divergence(df, **options).collect())


def test_divergence_of_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op12_source_divergence(spark, DATA).collect())
    assert got == brute_divergence(rows_of(docs), 30, 50)
    assert {r[2] for r in got} == {"pair", "term"}


@pytest.mark.parametrize("least, top, sizes", [(1, 3, (50_000, 256, 400_000)), (2, 2, (40, 3, 5)), (1, 50, (7, 1, 1)), (1000, 50, (50_000, 256, 400_000))])
def test_divergence_with_ties_blocks_and_tiles(spark, monkeypatch, least, top, sizes):
    """Many terms of equal cells, several blocks of terms, tiles of sources and flushes of the counts."""
    for name, size in zip(("BLOCK_CELLS", "TILE_SOURCES", "TERMS_HELD"), sizes):
        monkeypatch.setattr(divergence, name, size)
    rng = random.Random(3)
    words = ["Aa", "b_b", "cé", "Éc", "d1d", "\U0001f600x", "￮x", "e", "f", "G"] + [f"t{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 12))), rng.choice(["en", "", None, "de"]),
             rng.choice(["s1", "s2", None, "\U0001f600", "￮", "s3"]), 1) for i in range(120)]
    rows.append((999, "12 34", "only", "one", 1))
    docs = spark.createDataFrame(rows, DOCS)
    assert found_by(docs, least=least, top=top) == brute_divergence(rows_of(docs), least, top)


def test_divergence_counts_are_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([(10 ** 14, 3 * 10 ** 15, 10 ** 6), (0, 0, 1), (7, 9, 2)], "count long, total long, terms long")
    got = [r[0] for r in df.select(divergence.frequency(df["count"], df["total"], df["terms"])).collect()]
    assert got == [1 + 10 ** 9 * (c + 5) // (n + 5 * v) for c, n, v in ((10 ** 14, 3 * 10 ** 15, 10 ** 6), (0, 0, 1), (7, 9, 2))]


def test_divergence_of_awkward_rows(spark, awkward, nothing):
    docs = awkward.withColumnsRenamed({"words": "term", "n_words": "count", "kept": "rank"})
    for least in (1, 2, 50):
        assert found_by(docs, least=least) == brute_divergence(rows_of(docs), least, 50)
    assert found_by(nothing) == []


# manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, add=0):
    fields = [row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + add, row["text"]]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def brute_manifest(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r["lang"]].append(r)

    def levels_over(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def steps(levels, i):
        for level in levels[:-1]:
            yield i % 2, level[i ^ 1] if (i ^ 1) < len(level) else None
            i //= 2

    langs = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in langs:
        trees[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    built = {lang: levels_over([leaf_of(r) for r in trees[lang]]) for lang in langs}
    top = levels_over([built[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(trees[lang]):
            path = [*steps(built[lang], i), *steps(top, k)]
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            d = leaf_of(r, int(hit))
            for odd, s in path:
                d = digest(d) if s is None else digest(s, d) if odd else digest(d, s)
            out.append((r["doc_id"], leaf_of(r), built[lang][-1][0], top[-1][0], digest(*(s for _, s in path if s)), d, d == top[-1][0]))
    return Counter(out)


def manifest_of(df):
    return Counter(tuple(r) for r in merkle.manifest(df).collect())


def test_manifest_of_the_table(spark):
    got = Counter(tuple(r) for r in queries.op13_merkle_manifest(spark, DATA).collect())
    assert got == brute_manifest(rows_of(spark.read.parquet(f"{DATA}/documents.parquet")))
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, None: 1}, {"en": 9, "": 1, None: 3, "￮": 5, "\U0001f600": 16}])
def test_manifest_of_uneven_trees(spark, sizes):
    rows = [(100 * k - i, f"text {i % 2}", lang, None if i % 3 else "s", i if i % 4 else None) for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert manifest_of(docs) == brute_manifest(rows_of(docs))


def test_manifest_of_awkward_rows(spark, awkward, nothing):
    docs = awkward.withColumnsRenamed({"words": "tree", "n_words": "idx", "kept": "leaf"})
    assert manifest_of(docs) == brute_manifest(rows_of(docs))
    assert manifest_of(nothing) == Counter()
