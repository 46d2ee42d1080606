"""Near-duplicate documents by one-permutation MinHash, banded buckets and star-shaped candidate edges.

One hash of every shingle falls into one of many bins, and the smallest of each bin is kept; an empty bin takes the
value of a bin drawn for it by a hash of its own (optimal densification). Bins are joined into bands. Texts with equal
shingle sets are one class, and only class representatives enter the buckets.

In a bucket the members are compared with its center, not with each other, and a candidate becomes a link after the full
shingle sets have been compared. The center is the member that meets most others in all its buckets: of a group of near copies
one of the least changed. Where a star leaves a bucket in several components, further members become centers, twice as
many each round, for ROUNDS rounds. Buckets of up to 2^ROUNDS members are thereby compared in full. What is left of the larger
ones is compared by an exact index: shingles are put in one order, rare ones first, and two sets of enough similarity share
one among the first of both, however many of their other shingles belong to a template.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.llm.common import Hashes, as_bytes, mix, signed, small_batches, stored, window_hashes
from shelfmark.llm.graph import components

WIDTH = 5
PERCENT = 80
# Two texts of similarity 0.8 agree in a band with 0.8^6 = 0.26 and miss all 40 with 5 in a million.
BANDS = 40
ROWS = 6
BINS = BANDS * ROWS
ROUNDS = 3
SETS_HELD = 32
BLOCK_MEMBERS = 2000  # aimed at: larger sets of a shingle in one block


@lru_cache(maxsize=1)
def worker_hashes() -> Hashes:
    return Hashes()


def shingle_set(text: bytes, width: int, hashes: Hashes) -> np.ndarray:
    """Sorted hashes of the distinct runs of `width` words, A-Z lower-cased. A text with fewer words is one shingle, one
    without words has none."""
    words = hashes.of(text.lower().split())
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(width, len(words))))


def _probes(attempt: int) -> np.ndarray:
    """The bin that each bin looks at in this attempt."""
    return (mix(np.arange(BINS, dtype=np.uint64) + np.uint64(attempt + 1) * np.uint64(1_000_003)) % np.uint64(BINS)).astype(np.int64)


PROBES = [_probes(a) for a in range(64)]
EDGES = (np.arange(BINS + 1, dtype=object) * (1 << 64) // BINS)
LOWER = EDGES[:-1].astype(np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of every bin, empty bins densified. `shingles` are sorted and not empty."""
    place = mix(shingles)
    place.sort()
    first = np.searchsorted(place, LOWER)
    last = np.append(first[1:], len(place))
    filled = first < last
    value = place[np.minimum(first, len(place) - 1)]
    empty = np.flatnonzero(~filled)
    if filled.sum() == 1:
        value[empty] = value[filled][0]
        return value
    attempt = 0
    while len(empty):
        probe = (PROBES[attempt] if attempt < len(PROBES) else _probes(attempt))[empty]
        ok = filled[probe]
        value[empty[ok]] = value[probe[ok]]
        empty = empty[~ok]
        attempt += 1
    return value


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different bands never sharing one but by chance."""
    rows = signatures.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, r])
    return key


def _name(found: np.ndarray) -> np.ndarray:
    """128 bits that name a shingle set."""
    return np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (128 bits that name the shingle set), bands. Empty sets have no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_hashes()
        for batch in small_batches(batches):
            sizes, names, bands = [], [], []
            for text in as_bytes(batch.column(1)):
                found = shingle_set(text, width, hashes)
                sizes.append(len(found))
                names.append(_name(found))
                bands.append(signed(band_keys(signature(found))) if len(found) else np.empty(0, np.int64))
            named = np.stack(names) if names else np.empty((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(named[:, 0]), pa.array(named[:, 1]), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def _texts(docs: DataFrame, wanted: DataFrame, width: int, shared: DataFrame) -> DataFrame:
    """node and text, one row for each wanted class (node, rep, set_a, set_b). A doc_id of several rows may have several texts, so
    of those in `shared` (doc_id) the shingle set tells the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_hashes()
        for batch in small_batches(batches):
            node, first, second, text = batch.columns
            named = [_name(shingle_set(t, width, hashes)).tolist() for t in as_bytes(text)]
            own = [n == [a, b] for n, a, b in zip(named, first.to_pylist(), second.to_pylist())]
            yield pa.RecordBatch.from_arrays([node, text], names=["node", "text"]).filter(pa.array(own, pa.bool_()))

    texts = docs.select(docs["doc_id"].cast("long").alias("rep"), docs["text"])
    told = wanted.join(shared.select(F.col("doc_id").alias("rep"), F.lit(True).alias("several")), "rep", "left")
    met = stored(texts.join(told, "rep").select("node", F.coalesce("several", F.lit(False)).alias("several"), "set_a", "set_b", "text"), "texts")
    picked = met.where("several").select("node", "set_a", "set_b", "text").mapInArrow(run, "node long, text string")
    return met.where("NOT several").select("node", "text").unionByName(
        stored(picked.groupBy("node").agg(F.min("text").alias("text")), "texts"))


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets have at least `percent` of their union in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_hashes()
        sets: OrderedDict[int, np.ndarray] = OrderedDict()

        def of(node: int, text: bytes) -> np.ndarray:
            if node not in sets:
                sets[node] = shingle_set(text, width, hashes)
                if len(sets) > SETS_HELD:
                    sets.popitem(last=False)
            sets.move_to_end(node)
            return sets[node]

        for batch in small_batches(batches):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for x, y, s, t in zip(a, b, as_bytes(batch.column(2)), as_bytes(batch.column(3))):
                u, v = of(x, s), of(y, t)
                shared = len(np.intersect1d(u, v, assume_unique=True)) if 100 * min(len(u), len(v)) >= percent * max(len(u), len(v)) else 0
                keep.append(100 * shared >= percent * (len(u) + len(v) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long")


def _tokens(texts: DataFrame, width: int) -> DataFrame:
    """node, component, n (size of the set) and token, one row for each shingle of each text (node, component, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_hashes()
        for batch in small_batches(batches):
            sets = [shingle_set(text, width, hashes) for text in as_bytes(batch.column(2))]
            sizes = np.array([len(found) for found in sets], np.int64)
            at = pa.array(np.repeat(np.arange(len(sets)), sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.repeat(sizes, sizes)),
                 pa.array(signed(np.concatenate(sets)) if sets else np.empty(0, np.int64))], names=["node", "component", "n", "token"])

    return texts.select("node", "component", "text").mapInArrow(run, "node long, component long, n long, token long")


def prefixes(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of texts (node, component, text) the first shingles (token) of each in one order of all, by the number of the texts that
    have them (met), with the size of the set (n) and how many of it are left from this one on (rest). Two sets whose similarity is
    `percent` or more share one of them. Shingles of one component alone are left out."""
    tokens = stored(_tokens(texts, width), "tokens")
    counts = tokens.groupBy("token").agg(F.count("*").alias("met"), F.min("component").alias("x"), F.max("component").alias("y"))
    place = F.row_number().over(W.partitionBy("node").orderBy("met", "token"))
    ranked = tokens.join(counts, "token").withColumn("rest", F.col("n") - place + 1)
    # All but the smallest intersection that a similar set can have, and one.
    return ranked.where(f"rest >= ({percent} * n + 99) div 100 AND x < y").select("node", "component", "token", "met", "n", "rest")


def _unlinked(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that can have the similarity, by their prefixes: all that have it are among them.

    The first shingle that two sets share bounds what they share by what is left of either, so for the smaller set of a pair it
    lies in a shorter prefix still. A shingle that many have there is dealt out: the larger sets by blocks of BLOCK_MEMBERS, the smaller to all of them.
    """
    rows = stored(prefixes(texts, width, percent), "prefixes")
    blocks = F.ceil(F.col("met") / BLOCK_MEMBERS).cast("int")
    larger = rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    smaller = rows.where(f"{100 + percent} * rest >= {2 * percent} * n").withColumn(
        "block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return smaller.alias("a").join(larger.alias("b"), ["token", "block"]).where(
        ((F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.node") < F.col("b.node"))))
        & (F.col("a.component") != F.col("b.component")) & (100 * F.col("a.n") >= percent * F.col("b.n"))
        & ((100 + percent) * F.least("a.rest", "b.rest") >= percent * (F.col("a.n") + F.col("b.n")))
    ).select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per document doc_id, n_shingles, component_id (the smallest doc_id reachable over links, itself included), kept
    (doc_id = component_id).

    Null and empty texts have no shingles and no links. A row with a null doc_id cannot be named: it has no links, its
    component is null and it is kept. Rows that share a doc_id are one document with the links of all their texts. Copies of one
    text are one class, the node of the graph, so a group of copies of any size costs one member. Columns beyond doc_id and
    text are ignored.
    """
    sketch = stored(sketches(docs, width), "sketches")
    named = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    rows = classes.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("met")).where("met > 1")
    members = stored(rows.join(shared, "bucket"), "members")
    score = members.groupBy("node").agg(F.sum("met").alias("score"))
    members = stored(members.select("bucket", "node").join(score, "node"), "scored")

    several = stored(sketch.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "shared")
    wanted = classes.select("node", "rep", "set_a", "set_b").join(members.select("node").distinct(), "node")
    texts = _texts(docs, wanted, width, several)

    # The classes of a document that has several are one component from the start.
    own = named.select("doc_id", "set_a", "set_b").join(several, "doc_id").join(
        classes.select("set_a", "set_b", "node"), ["set_a", "set_b"]).select("doc_id", "node").distinct()
    own = stored(own, "own")
    least = own.groupBy("doc_id").agg(F.min("node").alias("a"))
    links = stored(own.join(least, "doc_id").where("a <> node").select("a", F.col("node").alias("b")), "links")

    spark = docs.sparkSession
    tested = spark.createDataFrame([], "a long, b long")
    where = components(links) if not links.isEmpty() else spark.createDataFrame([], "node long, component long")
    active = _open(members, where)
    for centers in (1 << k for k in range(ROUNDS)):
        # Buckets in one component are finished; in the others the next centers are compared with all that are left.
        if active.isEmpty():
            break
        chosen = _centers(active, centers)
        star = active.join(chosen, "bucket").where("component <> its").select(
            F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()
        pairs = stored(star.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionAll(pairs)
        links = links.unionAll(stored(verified(pairs, texts, width, percent), "links"))
        where = components(links)
        # Every member has been compared with these centers now, so they leave the bucket.
        active = _open(active.select("bucket", "node", "score").join(
            chosen.select("bucket", F.col("center").alias("node")), ["bucket", "node"], "left_anti"), where)
    if not active.isEmpty():
        rest = active.select("node", "component").distinct().join(texts, "node")
        pairs = stored(_unlinked(rest, width, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
        where = components(links.unionAll(verified(pairs, texts, width, percent)))

    # A component is named by its smallest doc_id.
    linked = where.join(classes.select("node", "rep"), "node")
    names = linked.groupBy("component").agg(F.min("rep").alias("name"))
    linked = stored(linked.join(names, "component").select("node", "name"), "names")
    found = classes.join(linked, "node", "left").select("node", "set_a", "set_b", F.coalesce("name", "rep").alias("component_id"))
    # Rows of such a document that have no shingles stand with its others.
    by_id = own.join(found.select("node", "component_id"), "node").groupBy("doc_id").agg(F.min("component_id").alias("of_id"))
    out = sketch.select("doc_id", "n_shingles", *(F.when(F.col("n_shingles") > 0, F.col(c)).alias(c) for c in ("set_a", "set_b")))
    placed = out.join(found.drop("node"), ["set_a", "set_b"], "left").join(by_id, "doc_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "of_id", "doc_id")).alias("component_id"))
    return placed.select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _open(members: DataFrame, where: DataFrame) -> DataFrame:
    """The members of buckets that are in more than one component, with their components."""
    placed = members.join(where, "node", "left").select(
        "bucket", "node", "score", F.coalesce("component", "node").alias("component"))
    several = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    return stored(placed.join(several, "bucket", "left_semi"), "active")


def _centers(active: DataFrame, count: int) -> DataFrame:
    """The `count` members of highest score of every bucket, with their components. One is found by an aggregate that combines
    before the shuffle; more are wanted only in the few buckets that are still open after the first round."""
    rank = F.struct("score", (-F.col("node")).alias("low"), "component")
    if count == 1:
        top = active.groupBy("bucket").agg(F.max(rank).alias("m"))
    else:
        order = W.partitionBy("bucket").orderBy(F.desc("score"), "node")
        top = active.withColumn("n", F.row_number().over(order)).where(F.col("n") <= count).select("bucket", rank.alias("m"))
    return top.select("bucket", (-F.col("m.low")).alias("center"), F.col("m.component").alias("its"))
