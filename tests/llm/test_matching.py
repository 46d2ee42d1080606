"""Operators that compare documents, against brute force in plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfmark.llm import decontaminate, graph, minhash, queries, toxicity
from tests.llm.conftest import DATA, DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# toxicity

def test_toxicity_on_held_out_rows(spark, documents):
    rows = {r.doc_id: r for r in queries.op2_cnn_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    held = [(rows[r.doc_id], r.toxic) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(x.held_out for x, _ in held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    toxic, other = [x.predicted for x, y in held if y == 1], [x.predicted for x, y in held if y == 0]
    assert np.mean(toxic) > 0.85 and np.mean(other) < 0.015


def test_pooling_and_gradients_agree_with_loops():
    rng = np.random.default_rng(0)
    texts = [b"a b c d", b"", b"x", b"d c b a b c"] * 12
    model = toxicity.train(texts, np.array([1, 0, 0, 1] * 12))
    model.table = rng.normal(0, 1, model.table.shape).astype(np.float32)
    got = toxicity.Scorer(model).raw(texts[:4])[0]
    for text, value in zip(texts, got):
        x = [sum(model.table[i] for i in toxicity.features(w)[:3]) for w in text.split()] + [np.zeros(toxicity.DIMENSION)] * 3
        best = [max(sum(x[i + j] @ model.filters[k][j][:, f] for j in range(k) if i + j < len(x)) for i in range(len(x)))
                for k in toxicity.WIDTHS for f in range(toxicity.FILTERS)]
        assert value == pytest.approx(np.maximum(np.array(best) + model.bias, 0) @ model.weights + model.offset, abs=1e-3)


def test_gradients_match_differences():
    """Of the loss of a few texts, by every kind of parameter."""
    rng = np.random.default_rng(5)
    texts = [np.arange(1, 6), np.arange(6, 9), np.array([9]), np.arange(10, 16)]
    ids, starts, ends = toxicity.joined(texts)
    x = rng.normal(0, 1, (len(ids), toxicity.DIMENSION))
    x[ids == 0] = 0
    n = toxicity.FILTERS * len(toxicity.WIDTHS)
    model = toxicity.Model(None, {k: rng.normal(0, 0.5, (k, toxicity.DIMENSION, toxicity.FILTERS)) for k in toxicity.WIDTHS},
                           rng.normal(0, 0.3, n), rng.normal(0, 0.5, n), 0.2, None)
    labels, weight = np.array([1, 0, 1, 0]), np.array([0.5, 0.2, 0.7, 0.4])

    def loss():
        best = [max(sum(x[i + j] @ model.filters[k][j][:, f] for j in range(k) if i + j < len(x)) for i in range(a, b))
                for a, b in zip(starts, ends) for k in toxicity.WIDTHS for f in range(toxicity.FILTERS)]
        z = np.maximum(np.array(best).reshape(len(texts), n) + model.bias, 0) @ model.weights + model.offset
        return (weight * np.logaddexp(0, np.where(labels == 1, -z, z))).sum()

    steps, of_filters, of_words = toxicity.gradients(model, x, starts, ends, labels, weight)

    def check(values, grads, some=12):
        for at in rng.permutation(values.size)[:some]:
            ends_ = []
            for move in (1e-5, -2e-5):
                values.flat[at] += move
                ends_.append(loss())
            values.flat[at] += 1e-5
            assert (ends_[0] - ends_[1]) / 2e-5 == pytest.approx(grads.flat[at], abs=1e-4)

    check(model.weights, steps["weights"])
    check(model.bias, steps["bias"])
    for k in toxicity.WIDTHS:
        check(model.filters[k], of_filters[k])
    check(x, of_words, 40)
    before = loss()
    model.offset += 1e-5
    assert (loss() - before) / 1e-5 == pytest.approx(steps["offset"], abs=1e-3)


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(3, 1), (5, 0), (3, 1), (None, 0), (7, None)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 4)}) == 1
    assert toxicity.score_toxicity(nothing, labels.limit(0)).count() == 0


def test_a_language_of_few_labels_has_its_own_threshold(spark):
    """In German a word is harmless that English uses in toxic texts only; a quarter of its labels would be too few."""
    rng = random.Random(8)
    rows = []
    for lang, mark, toxic, n in [("en", "mild", 1, 100), ("en", "vile", 1, 100), ("en", "", 0, 2000), ("de", "vile", 1, 50), ("de", "mild", 0, 50)]:
        for _ in range(n):
            filler = [f"{lang}{rng.randrange(300)}" for _ in range(12)] + toxicity.FUNCTION_WORDS[lang].split()[:8]
            at = rng.randrange(len(filler))
            rows.append((len(rows), " ".join([*filler[:at], mark, *filler[at:]]), toxic, lang + mark))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, kind string")
    found = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, docs.select("doc_id", "toxic")).collect()}
    share = {k: np.mean([found[d] for d, _, _, kind in rows if kind == k]) for k in ("enmild", "envile", "en", "devile", "demild")}
    assert min(share["enmild"], share["envile"], share["devile"]) > 0.9 and max(share["en"], share["demild"]) < 0.1, share


# near duplicates

def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_components(docs, width, percent=80):
    """Every pair that shares a shingle, by an exact index."""
    sets = {d: shingles(t, width) for d, t in docs}
    where, parent = defaultdict(list), {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    same = defaultdict(list)
    for d, s in sets.items():
        if s:
            same[frozenset(s)].append(d)
    for copies in same.values():
        for d in copies:
            parent[max(root(d), root(copies[0]))] = min(root(d), root(copies[0]))
    reps = [c[0] for c in same.values()]
    shared = defaultdict(int)
    for d in reps:
        for s in sets[d]:
            for e in where[s]:
                shared[e, d] += 1
            where[s].append(d)
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_near_duplicates_match_brute_force(spark, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_minhash_stars(spark, DATA).collect()}
    want = brute_components(documents, 2)
    assert got == want and sum(d != c for d, (_, c) in want.items()) > 40


def test_links_inside_buckets_of_unlike_members_are_found(spark):
    """Many texts that share much but not enough, and a few true pairs among them."""
    rng = random.Random(5)
    common = [f"c{i}" for i in range(60)]
    docs = []
    for d in range(60):
        own = [f"w{d}x{i}" for i in range(18)]
        docs.append((2 * d, " ".join(common + own)))
        if d % 7 == 0:
            docs.append((2 * d + 1, " ".join(common + own[:-3] + [f"z{rng.random()}"])))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()}
    want = {d: c for d, (_, c) in brute_components(docs, 2).items()}
    assert got == want and len(set(want.values())) == 60


def test_links_that_share_only_the_bands_of_a_template_are_found(spark):
    """More texts than the star rounds compare, all just under the similarity with each other, half of them in true pairs."""
    template, docs = [f"c{i}" for i in range(120)], []
    for d in range(80):
        own = [f"w{d}x{i}" for i in range(16)]
        docs.append((2 * d, " ".join(template + own)))
        if d % 2 == 0:
            docs.append((2 * d + 1, " ".join(template + own[:2] + [f"z{d}x{i}" for i in range(14)])))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()}
    want = {d: c for d, (_, c) in brute_components(docs, 2).items()}
    assert len(set(want.values())) == 80 and got == want


def components_of(spark, rows, width=2):
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return sorted((r.doc_id, r.component_id) for r in found)


def test_rows_that_share_a_doc_id_are_one_document(spark):
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    a, b = words(30), words(30)
    near_a, near_b, far_b = a[:-1] + ["x"], b[:-1] + ["y"], b[:14] + words(16)
    text = " ".join
    assert components_of(spark, [(1, text(a)), (1, text(b)), (0, text(b))]) == [(0, 0), (1, 0), (1, 0)]
    assert components_of(spark, [(5, text(a)), (5, text(b)), (6, text(near_a)), (7, text(near_b)), (8, text(b[1:]))]) == [
        (5, 5), (5, 5), (6, 5), (7, 5), (8, 5)]
    # The second text of an id is compared by its own shingles, and repeated rows and rows without words change nothing.
    rows = [(5, text(a)), (5, text(b)), (5, text(b)), (5, ""), (5, None), (4, text(near_b)), (6, text(far_b)), (9, text(a)), (2, "")]
    assert components_of(spark, rows) == [(2, 2), (4, 4), *[(5, 4)] * 5, (6, 6), (9, 4)]


def test_the_exact_index_proposes_little_among_templates_and_background(spark):
    """Families that share a template just under the similarity, with a few true pairs, among many texts of other words."""
    rng = random.Random(6)
    rows, want, node = [], set(), 0
    for family in range(3):
        template = [f"t{family}x{i}" for i in range(100)]
        for d in range(150):
            own = [f"f{family}w{d}x{i}" for i in range(14)]
            rows.append((node, node, " ".join(template + own)))
            node += 1
            if d % 10 == 0:
                rows.append((node, node, " ".join(template + own[:-1] + ["z"])))
                want.add((node - 1, node))
                node += 1
    for _ in range(50_000):
        rows.append((node, node, " ".join(f"b{rng.randrange(40_000)}" for _ in range(12))))
        node += 1
    texts = spark.createDataFrame(rows, "node long, component long, text string")
    found = {(r.a, r.b) for r in minhash._unlinked(texts, 2, 80).collect()}
    assert found >= want and len(found) < len(want) + 2000, len(found)


@pytest.mark.parametrize("block", [2000, 3])
def test_the_exact_index_loses_no_pair(spark, monkeypatch, block):
    """All pairs of 0.8 or more among texts of few words, of many sizes, with shingles that most have in common."""
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", block)
    rng = random.Random(7)
    docs = []
    for d in range(400):
        base = [f"c{i}" for i in range(rng.randrange(4, 40))]
        for _ in range(rng.randrange(0, 8)):
            base[rng.randrange(len(base))] = f"v{rng.randrange(30)}"
        docs.append((d, " ".join(base)))
    sets = {d: shingles(t, 2) for d, t in docs}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    texts = spark.createDataFrame([(d, d, t) for d, t in docs], "node long, component long, text string")
    pairs = minhash._unlinked(texts, 2, 80)
    assert {(r.a, r.b) for r in pairs.collect()} >= want and len(want) > 200
    assert {(r.a, r.b) for r in minhash.verified(pairs, texts, 2, 80).collect()} == want


def test_near_duplicates_of_awkward_rows(spark, awkward, nothing):
    rows = minhash.near_duplicates(awkward, 2).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        if r.doc_id in (1, 2, 4):
            assert (r.n_shingles, r.component_id, r.kept) == (0, r.doc_id, True)
        if r.doc_id is None:
            assert r.component_id is None and r.kept
    assert minhash.near_duplicates(nothing).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    parent = list(range(500))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (3, 40, 900):
        agree = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, n + n // 4 + 1).astype(np.uint64)
            a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:n - n // 9], pool[n:n + n // 9]]))
            agree.append((minhash.signature(a) == minhash.signature(b)).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(agree)) < 0.05


# decontamination

def plain(text):
    return [w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", w.lower()) for w in text.split()) if w]


def test_leaks_match_brute_force(spark, documents):
    got = {(r.doc_id, r.item_id): r for r in queries.op6_simhash_windows(spark, DATA).collect()}
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = set()
    for doc, text in documents:
        words = "\x00".join(["", *plain(text), ""])
        want |= {(doc, i) for i, w in items if "\x00".join(["", *w, ""]) in words}
    assert want and set(got) >= want and all(got[k].similarity > 0.999 and got[k].hamming == 0 for k in want)
    assert all(r.similarity >= 0.8 for r in got.values()) and len(got) <= len(want) + 3


def test_all_fingerprints_within_the_radius_are_found():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**63, 20).astype(np.uint64)
    near = np.zeros((decontaminate.BLOCKS, 1 << 16), bool)
    for b, row in enumerate(prints.view(np.uint16).reshape(-1, 4).T):
        for v in row.tolist():
            near[b, decontaminate.near_values(v, decontaminate.RADIUS // decontaminate.BLOCKS)] = True
    size = decontaminate.Size(9, np.arange(20), prints, near)
    windows = []
    for p in prints.tolist() * 40:
        for bit in rng.choice(64, rng.integers(0, 16), replace=False).tolist():
            p ^= 1 << bit
        windows.append(p)
    windows = np.array(windows, np.uint64)
    at, item, distance = size.hits(windows)
    full = np.bitwise_count(windows[:, None] ^ prints[None])
    assert {(a, i): d for a, i, d in zip(at.tolist(), item.tolist(), distance.tolist())} == {
        (a, i): full[a, i] for a, i in zip(*(x.tolist() for x in np.nonzero(full <= decontaminate.RADIUS)))}


def test_fingerprints_match_a_plain_simhash():
    rng = np.random.default_rng(6)
    values = rng.integers(0, 2**63, 700).astype(np.uint64)
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1)
    for count in (1, 2, 30, 255, 256, 600):
        want = [np.packbits(bits[i:i + count].sum(0) > count // 2).view(np.uint64)[0] for i in range(len(values) - count + 1)]
        assert decontaminate.fingerprints(decontaminate.counters(values), count).tolist() == [int(w) for w in want]


def test_edited_and_long_texts(spark):
    rng = random.Random(9)
    item = [f"b{rng.randrange(10**6)}" for _ in range(50)]
    noise = [f"n{rng.randrange(10**6)}" for _ in range(230_000)]
    edited = item[:-2] + ["x1", "x2"]
    docs = [(1, " ".join(noise[:150_000] + item + noise[150_000:])), (2, " ".join(edited)), (3, " ".join(noise)),
            (4, " ".join(noise[:99_990] + item + noise[99_990:])), (5, " ".join(w.upper() + "," for w in item)), (6, None)]
    rows = decontaminate.contaminated(spark.createDataFrame(docs, DOCS.split(", lang")[0]),
                                      spark.createDataFrame([(7, " ".join(item)), (8, None), (9, ""), (None, "q r s")], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.start) for r in rows) == [(1, 7, 150_000), (2, 7, 0), (4, 7, 99_990), (5, 7, 0)]


def test_items_edited_to_just_the_similarity_are_found():
    """One word changed anywhere, one left out or added: all windows of the item's length, one by one, against the search."""
    rng = random.Random(3)
    words = lambda n: np.array([rng.getrandbits(64) | 1 for _ in range(n)], np.uint64)
    items = [(i, words(rng.randrange(48, 62))) for i in range(60)]
    docs = []
    for _, item in items:
        at = rng.randrange(len(item))
        edited = [np.concatenate([item[:at], words(1), item[at + 1:]]), np.delete(item, at), np.insert(item, at, words(1))]
        docs += [np.concatenate([words(30), e, words(30)]) for e in edited]
    bench = decontaminate.Benchmark(items)
    got = {(d, i): (start, like) for d, i, start, _, _, like in bench.search(docs)}
    want = {}
    for d, doc in enumerate(docs):
        n = len(items[d // 3][1])
        like, start = max((bench.similarity(d // 3, doc[s:s + n]), -s) for s in range(len(doc) - n + 1))
        if like >= decontaminate.SIMILARITY:
            want[d, d // 3] = (-start, like)
    assert len(want) > 100 and got == want


def test_parts_of_the_benchmark_change_no_result(spark, monkeypatch):
    """Items that share openings, so that weights differ from item to item, in parts of three sizes and in any order of rows."""
    rng = random.Random(12)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    opening = words(14)
    items = [(i, opening[:rng.randrange(8, 15)] + words(rng.randrange(60, 75))) for i in range(90)]
    docs = []
    for i, item in items:
        edited = list(item)
        edited[rng.randrange(16, len(item))] = "changed"
        docs.append((i, " ".join(words(10) + edited + words(5))))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = []
    for at_once, order in ((200_000, "item_id"), (3000, "item_id"), (1000, "text")):
        monkeypatch.setattr(decontaminate, "ITEM_WORDS_AT_ONCE", at_once)
        rows = decontaminate.contaminated(docs, bench.orderBy(order)).collect()
        found.append(sorted((r.doc_id, r.item_id, r.start, r.n_words, r.hamming, round(r.similarity, 12)) for r in rows))
        kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
        assert kept == {i for i, _ in items} - {r[0] for r in found[-1]}
    assert len(found[0]) > 40 and found[0] == found[1] == found[2]


def test_block_lists_keep_most_pairs_from_being_compared():
    """5,000 items of one size: a window meets about one in 120 of them, and none within the radius is lost."""
    rng = np.random.default_rng(8)
    prints = rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 5000).astype(np.uint64)
    near = np.zeros((decontaminate.BLOCKS, 1 << 16), bool)
    for b, row in enumerate(prints.view(np.uint16).reshape(-1, 4).T):
        for v in set(row.tolist()):
            near[b, decontaminate.near_values(v, decontaminate.RADIUS // decontaminate.BLOCKS)] = True
    size = decontaminate.Size(50, np.arange(5000), prints, near)
    windows = rng.integers(0, 2**63, 2000).astype(np.uint64)
    windows[::10] = prints[:200] ^ np.uint64(0b1000010000100)
    compared = sum(len(at) for _, at, _ in size.candidates(windows))
    assert compared < 2000 * 5000 / 80
    full = np.nonzero(np.bitwise_count(windows[:, None] ^ prints[None]) <= decontaminate.RADIUS)
    at, item, _ = size.hits(windows)
    assert sorted(zip(at.tolist(), item.tolist())) == sorted(zip(*(x.tolist() for x in full)))


def test_all_similar_windows_match_brute_force(spark, documents):
    """Every window of an item's own length in every document that shares a shingle with it, by the exact similarity."""
    plain_words = decontaminate.PlainWords()
    bench = decontaminate.Benchmark([(r.item_id, plain_words.of(r.text.encode())) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()])
    holders = {}
    for k, counts in enumerate(bench.counts):
        for s in counts:
            holders.setdefault(s, []).append(k)
    want = {}
    for doc, text in documents:
        words = plain_words.of((text or "").encode())
        met = Counter(k for s in set(decontaminate.shingles(words).tolist()) for k in holders.get(s, ()))
        for k in met:
            n = len(bench.items[k][1])
            best = max((bench.similarity(k, words[s:s + n]), -s) for s in range(max(1, len(words) - n + 1)))
            if best[0] >= decontaminate.SIMILARITY:
                want[doc, bench.items[k][0]] = (round(best[0], 9), -best[1])
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in queries.op6_simhash_windows(spark, DATA).collect()}
    assert want and got == want


def test_leaks_of_awkward_rows(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (2, "a b c a b c a b c")], "item_id long, text string")
    rows = decontaminate.contaminated(awkward, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in rows), key=str) == [(5, 2), (7, 1), (7, 1), (None, 1), (None, 1)]
    assert decontaminate.contaminated(nothing, bench).count() == 0 and decontaminate.contaminated(awkward, bench.limit(0)).count() == 0
