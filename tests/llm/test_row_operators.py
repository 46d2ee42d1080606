"""Operators that judge a row at a time, against brute force in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfmark.llm import hilbert, packing, quality, queries, secrets, urls
from tests.llm.conftest import DATA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def as_dict(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# secrets

RAW = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace(
        "(password|passwd|secret|token|api_?key)", "(?i:(password|passwd|secret|token|api_?key))"), re.A), 2, 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 18), "hex": (re.compile("[0-9a-f]+"), 0, 16),
}


def brute_spans(text):
    found = [(m.start(), k, m.end(), name) for k, (name, (rx, group, least)) in enumerate(RAW.items())
             for m in rx.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(found)


def test_secrets_match_brute_force(spark, documents):
    got = as_dict(queries.op4_trigram_secrets(spark, DATA))
    assert len(got) == len(documents)
    seen = Counter()
    for doc, text in documents:
        spans = brute_spans(text)
        counts = Counter(s[3] for s in spans)
        seen += counts
        row = got[doc]
        assert (row.n_assign, row.n_access, row.n_hex) == (counts["assign"], counts["access"], counts["hex"])
        joined = ",".join(f"{n}:{a}:{b}" for a, _, b, n in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert {s for s in row.spans.split(",") if s} >= {s for s in joined.split(",") if s}
    assert min(seen["assign"], seen["hex"]) > 3


@pytest.mark.parametrize("pattern, query", [
    ("abcd", ("and", b"abc", b"bcd")), ("[0-9a-f]+", True), ("(abc|xyz)", ("or", b"abc", b"xyz")), ("AKIA[A-Z]+", ("and", b"aki", b"kia")),
    ("abc|x", True), ("ab?c", True), ("(?:abc){2,}", ("and", ("and", ("and", b"abc", b"bca"), b"cab"), b"abc")),
])
def test_trigram_queries(pattern, query):
    got = secrets.trigram_query(pattern)
    assert secrets.trigrams_of(got) == secrets.trigrams_of(query) and (got is True) == (query is True)


def test_candidates_lose_no_match():
    texts = ["my PassWord: abcdefghijkl", "api_key=0123456789ab", "apikey = 'aaaaaaaaaaaaa'", "AKIA1234567890ABCD", "nothing", "",
             "-----BEGIN RSA PRIVATE KEY-----", "https://user:secretpw@host/x", "\u212aey token=\u017fabcdefghijklm", "x" * 100_000 + "f" * 20,
             "Authorization: Bearer abcdefghijklmnopqrst", "eyJabcdefgh12.eyJabcdefgh12.abcdefgh12"]
    scanned = secrets.Scanner(secrets.RULES).scan([t.encode() for t in texts])
    for text, spans in zip(texts, scanned):
        assert spans == sorted((a, k, b) for k, r in enumerate(secrets.RULES) for a, b in r.spans(text))
    assert sum(map(len, scanned)) >= 9


def test_secrets_of_awkward_rows(spark, awkward, nothing):
    rows = secrets.secret_digest(secrets.find_secrets(awkward)).collect()
    assert len(rows) == awkward.count()
    assert {r.n_assign for r in rows if r.doc_id in (1, 2, 4)} == {0}
    assert [r.n_assign > 1000 for r in rows if r.doc_id == 3] == [True, True]
    assert secrets.find_secrets(nothing).count() == 0
    clean = secrets.redact(awkward)
    assert clean.columns == awkward.columns and clean.count() == awkward.count()
    texts = as_dict(clean)
    assert texts[1].text is None and texts[2].text == "" and "password=abc" not in texts[3].text
    assert texts[3].n_chars == len(texts[3].text)


# urls

def test_automaton_matches_regex():
    globs = ["net/**", "*.net/**", "a?c/*/x", "**.js", "**", "*", "", "ab**yz", "x/*" + "q" * 90, "**/ads/**"]
    texts = [b"", b"net/", b"a.net/b/c.js", b"a.b.net/x", b"abc/d/x", b"a/c/d/x", b"abyz", b"ab/1/yz", b"x/" + b"q" * 90, b"x/" + b"z" * 5000 + b"q" * 90, b"h/ads/"]
    def regex(g):
        return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in re.split(r"(\*\*|\*|\?)", g)).encode())
    got = urls.Automaton(globs).match(texts)
    assert got.tolist() == [[bool(regex(g).fullmatch(t)) for g in globs] for t in texts]


def test_urls_by_hand(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://NET/x"), (4, "http://a.net"), (5, "http://www.example.net/en/1?x://y"), (6, "x://notnet/"),
            (7, "http://a.org/fr/"), (8, "http://a.org/fr"), (9, "https://example.com/de/x#f"), (10, "http://h/ads/x"), (None, "http://h/\u00e9"), (3, "http://NET/x")]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()
    found = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str)
    assert found == sorted([
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "net", "/x", "net/", "block"), (3, "net", "/x", "net/", "block"),
        (4, "a.net", "", None, "allow"), (5, "www.example.net", "/en/1", "example.net/en/", "allow"), (6, "notnet", "/", None, "allow"),
        (7, "a.org", "/fr/", "org/fr/", "allow"), (8, "a.org", "/fr", None, "allow"), (9, "example.com", "/de/x", "example.com/de/", "block"),
        (10, "h", "/ads/x", None, "block"), (None, "h", "/\u00e9", None, "allow")], key=str)


def test_very_long_urls_are_read_whole_and_soon(spark):
    rng = random.Random(2)
    tails = ["/login", "/x.jpg", "/ads/y", ".jpg/", "/en/"]
    rows = [(i, "http://" + rng.choice(["a.net", "example.net", "ads.x", "h"]) + "/" + "ab/c" * (rng.randrange(3) * 60_000) + rng.choice(tails)) for i in range(40)]
    rows.append((99, "http://example.net/en/" + "q" * 1_000_000 + ".jpg"))
    started = time.monotonic()
    got = as_dict(urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")), "page_id")
    assert time.monotonic() - started < 20 and got[99].verdict == "allow" and got[99].glob == "**.jpg"
    patterns = [g.pattern for g in urls.GLOBS]
    regexes = [re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p) or re.escape(p) for p in re.split(r"(\*\*|\*|\?)", g) if p), re.S)
               for g in patterns]
    for i, url in rows[:-1]:
        text = got[i].host + got[i].path
        assert got[i].glob == next((g for g, rx in zip(patterns, regexes) if rx.fullmatch(text)), None)


def test_urls_of_empty_tables_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string").selectExpr(
        "*", "'q' AS host", "'r' AS path", "1 AS rule", "2 AS verdict", "3 AS `glob`", "4 AS page")
    assert [(r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages).collect()] == [("a.net", "/x", "net/", "block")]
    assert urls.judge_urls(pages.limit(0)).collect() == []


# quality

def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if count[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_quality_matches_brute_force(spark, documents):
    got = as_dict(queries.op5_decision_list(spark, DATA))
    assert len(got) == len(documents)
    for doc, text in documents:
        row, want = got[doc], brute_statistics(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert row.kept == (not row.base_failed and row.rule_id is None)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [got[d] for d, q in labels.items() if q == 1 and not got[d].base_failed]
    bad = [got[d] for d, q in labels.items() if q == 0 and not got[d].base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.7 * len(bad)


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judge_quality(awkward, labels).collect()
    assert len(rows) == awkward.count() and {r.n_words for r in rows if r.doc_id in (1, 2, 4)} == {0}
    for r in rows:
        if r.doc_id == 5:
            assert r.n_repeat_words == 9
        if r.doc_id == 6:
            assert (r.n_words, r.word_chars) == (2, 6)
    assert quality.judge_quality(nothing, labels).count() == 0


def test_rules_are_learned_from_one_label_a_document(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (3, None), (None, 0), (4, 7)], "doc_id long, quality int")
    assert sorted((r.labelled, r.reject) for r in quality.labelled(labels).collect()) == [(1, 1), (2, 0)]


def test_the_filter_and_the_judgement_agree(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in quality.keep_good(docs, labels).select("doc_id").collect()}
    assert kept == {r.doc_id for r in quality.judge_quality(docs, labels).where("kept").collect()}


def plain_covering(rows):
    """Sequential covering in plain Python: grow by information gain on two thirds of the rows, prune on the others."""
    marks = [i / quality.THRESHOLDS for i in range(quality.THRESHOLDS + 1)]
    names = list(quality.FEATURES)
    edges = {}
    for f in names:
        cuts = set()
        for k in (0, 1):
            values = sorted(r[f] for r in rows if r["reject"] == k and r[f] is not None)
            cuts |= {values[max(0, math.ceil(m * len(values)) - 1)] for m in marks} if values else set()
        edges[f] = sorted(cuts)

    def holds(rule, r):
        return all(r[f] is not None and ((r[f] >= t) == above) for f, above, t in rule)

    def best(rows, features):
        bad, good = sum(r["reject"] for r in rows), sum(1 - r["reject"] for r in rows)
        chosen, top = None, (1e-9, 0)
        if not bad or not good:
            return None
        for f in features:
            for t in edges[f][1:]:
                for above in (True, False):
                    inside = [r["reject"] for r in rows if holds([(f, above, t)], r)]
                    p, q = sum(inside), len(inside) - sum(inside)
                    if p and (score := (p * (math.log2(p / (p + q)) - math.log2(bad / (bad + good))), -q)) > top:
                        chosen, top = (f, above, t), score
        return chosen

    rules, starts = [], list(names)
    while starts and len(rules) < quality.MAX_RULES:
        left = [r for r in rows if not any(holds(x, r) for x in rules)]
        grow, prune = [r for r in left if not r["prunes"]], [r for r in left if r["prunes"]]
        grown = []
        while len(grown) < quality.MAX_CONDITIONS:
            condition = best([r for r in grow if holds(grown, r)], names if grown else starts)
            if condition is None:
                break
            grown.append(condition)
        if not grown:
            break
        counts = []
        for k in range(1, len(grown) + 1):
            inside = [r["reject"] for r in prune if holds(grown[:k], r)]
            counts.append((sum(inside), len(inside) - sum(inside)))
        k = max(range(len(counts)), key=lambda k: ((counts[k][0] - counts[k][1]) / (sum(counts[k]) + 1), -k))
        p, q = counts[k]
        if p >= quality.LEAST_COVERED and p >= quality.LEAST_PRECISION * (p + q):
            rules.append(grown[:k + 1])
        else:
            starts.remove(grown[0][0])
    return rules


def test_the_learner_matches_plain_covering(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        values = {f: rng.randrange(40) / 40 for f in quality.FEATURES}
        if i % 17 == 0:
            values["digits"] = None
        reject = int(values["symbols"] > 0.7 and values["marks"] < 0.6 or (values["digits"] or 0) > 0.9)
        rows.append((i, reject, *values.values()))
    df = spark.createDataFrame(rows, "doc_id long, reject int, " + ", ".join(f"f_{f} double" for f in quality.FEATURES))
    prunes = {r.doc_id: r.p for r in df.selectExpr("doc_id", "pmod(xxhash64(doc_id), 3) = 0 AS p").collect()}
    want = plain_covering([{"reject": r[1], "prunes": prunes[r[0]], **dict(zip(quality.FEATURES, r[2:]))} for r in rows])
    got = [[(c.feature, c.above, c.threshold) for c in rule] for rule in quality.learn_rules(df)]
    assert got == want and len(got) >= 2


# packing

def test_packing_round_trip(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    pieces = packing.pack(spark.read.parquet(f"{DATA}/documents.parquet").repartition(3), queries.tokenizer_path()).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc, text in documents:
        want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        parts = sorted(by_doc[doc], key=lambda p: p.start)
        assert [i for p in parts for i in p.ids] == want and {p.doc_tokens for p in parts} == {len(want)}
        assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
    used = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        used += at
    assert used >= 0.98 * 1024 * len(by_sequence)


def test_both_forms_pack_alike(spark, monkeypatch):
    """With and without the ids, and with several turns in a task."""
    monkeypatch.setattr(packing, "BYTES_AT_ONCE", 40_000)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").coalesce(1)
    places = [sorted((p.doc_id, p.start, p.length, p.ids_crc32, p.sequence_id, p.offset) for p in packing.pack(
        docs, queries.tokenizer_path(), with_ids=ids).collect()) for ids in (True, False)]
    assert places[0] == places[1]


def test_best_fit_decreasing_takes_the_tightest_window():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 65, 500)
    window, offset, opened = packing.best_fit_decreasing(lengths, 64)
    free: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [f for f in free if f >= lengths[i]]
        if not fits:
            free.append(64)
            fits = [64]
        assert offset[i] == 64 - min(fits)
        free[free.index(min(fits))] -= lengths[i]
    assert opened == len(free)
    assert packing.best_fit_decreasing(np.empty(0, np.int64), 64)[2] == 0


def test_encoder_on_white_space_and_special_tokens():
    encoder = packing.Encoder(queries.tokenizer_path())
    texts = ["a  b", " x", "x ", "a\n b", "a \nb", "ab c d", "x\ty z", "it's a <|endoftext|> b", "a\n\nb c\n", "\u00e9 \u00b2 12 '' \u3000 k", "", "a 'll b", "a \u00a0b", "  "]
    assert encoder.fast is not None
    for text in [*texts, "x" * 3000, "\U0001f600 ok", "caf\u00e9 \u4e2d\u6587 1\u00bd"]:
        assert encoder.encode(text) == encoder.plain(text)


def test_packing_of_awkward_rows(spark, awkward, nothing):
    rows = packing.pack(awkward, queries.tokenizer_path()).collect()
    assert sorted(r.doc_tokens for r in rows if r.doc_id in (1, 2)) == [1, 1]
    assert sum(r.start == 0 for r in rows if r.doc_id == 3) == 2 and any(r.doc_id is None for r in rows)
    assert packing.pack(nothing, queries.tokenizer_path()).count() == 0


# sharding

def test_hilbert_index_is_a_continuous_walk(spark):
    from pyspark.sql import functions as F

    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = spark.range(1 << (dims * bits)).select(*(
            F.shiftright("id", bits * d).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(f"x{d}") for d in range(dims)))
        rows = cells.withColumn("h", hilbert.hilbert_index([F.col(f"x{d}") for d in range(dims)], bits)).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(1 << (dims * bits)))
        assert all(sum(abs(a[d] - b[d]) for d in range(dims)) == 1 for a, b in zip(rows, rows[1:]))


def test_shards(spark, documents):
    rows = queries.op10_hilbert_shards(spark, DATA).collect()
    text = dict(documents)
    assert sorted(r.doc_id for r in rows) == sorted(text)
    slots = defaultdict(list)
    for r in rows:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert len({r.curve for r in rows}) > 300
    # Files are narrower in every dimension than files in any fixed order of one column would be in the others.
    spread = np.mean([max(x) - min(x) for x in (
        [r.size for r in rows if r.shard == s] for s in range(24))])
    assert spread < 0.8 * (max(r.size for r in rows) - min(r.size for r in rows))


def test_shards_of_awkward_rows(spark, awkward, nothing):
    rows = hilbert.document_shards(awkward, 24).collect()
    assert len(rows) == awkward.count() and {r.size for r in rows if r.doc_id in (1, 2)} == {8}
    assert max(Counter(r.shard for r in rows).values()) == 1
    assert hilbert.document_shards(nothing, 24).count() == 0


def test_shards_are_runs_of_the_curve(spark):
    """No row of a shard lies before one of an earlier shard on the curve, and slots follow the curve inside a shard."""
    rows = sorted((r.shard, r.slot, r.curve) for r in queries.op10_hilbert_shards(spark, DATA).collect())
    curves = [c for _, _, c in rows]
    assert curves == sorted(curves) and len(set(curves)) > 100
    # Neighbours on the curve are neighbours in one dimension.
    cells = spark.range(1 << 6).selectExpr("CAST(id div 8 AS INT) AS x", "CAST(id % 8 AS INT) AS y")
    walk = sorted((r.d, r.x, r.y) for r in cells.withColumn("d", hilbert.hilbert_index([cells["x"], cells["y"]], 3)).collect())
    assert [d for d, _, _ in walk] == list(range(64))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(walk, walk[1:]))


def test_shards_refuse_clashing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "x int, shard int")
    with pytest.raises(ValueError, match="shard"):
        hilbert.hilbert_shards(df, {"x": df["x"]}, [df["x"]], 2)
