"""Removal of repeated passages by prefix-partitioned suffix trees.

Every word position starts a suffix, cut at `window` words: whatever repeats further down hangs under a node of that
depth. Suffixes are dealt to groups by their prefixes. A first pass counts suffixes by a hash of their first few words; frequent
prefixes are lengthened up to the window, rare ones share a group, and so every group has a bounded number of suffixes.
Of the subtree of a group only the nodes at that depth are wanted, and one task finds them by sorting the suffixes by the hash
of their path: runs of equal paths are the nodes, and of the leaves under one all but the first start a repeated passage. The words
themselves, from which a whole tree could be built, stay where they are read: they would be twenty times as much to shuffle. Starts that follow each other
in a document make up the maximal repeats, whose words are removed.

Leaves that a block of documents already holds under an earlier one are settled where they are read, so copies of a
document or a passage held by any share of the corpus cost one leaf per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Hashes, as_bytes, small_batches, window_hashes

WINDOW = 20
PREFIX = 4  # words that deal a suffix first
BUCKET_BITS = 16
GROUP_SUFFIXES = 1_000_000
BLOCK_ROWS = 2048
BLOCK_WORDS = 600_000
# Of the 64-bit path. In a group of a million, two paths agree by chance with odds of 1 in 100,000: over 10^13 words some 70 windows
# would be taken for repeats that are none. Eight bytes make that 0.3 and cost a quarter of the input more in shuffles.
PATH_BYTES = 7


@lru_cache(maxsize=1)
def worker_hashes() -> Hashes:
    return Hashes()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """doc_ids and hashed words of a block of documents; rows without an id have no part in the comparison."""
    hashes = worker_hashes()
    ids, words, held = [], [], 0
    for batch in small_batches(batches):
        for doc, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            if doc is None:
                continue
            found = hashes.of(text.split())
            ids.append(doc)
            words.append(found)
            held += len(found)
            if len(ids) >= BLOCK_ROWS or held >= BLOCK_WORDS:
                yield np.array(ids, np.int64), words
                ids, words, held = [], [], 0
    if ids:
        yield np.array(ids, np.int64), words


def _suffixes(ids: np.ndarray, words: list[np.ndarray], window: int):
    """(document, position, path hash, prefix bucket) of all suffixes of a block that have `window` words."""
    docs, places, paths, buckets = [], [], [], []
    for doc, found in zip(ids, words):
        path = window_hashes(found, window)
        if len(path):
            docs.append(np.full(len(path), doc, np.int64))
            places.append(np.arange(len(path), dtype=np.int64))
            paths.append(path)
            buckets.append(window_hashes(found, min(PREFIX, window))[:len(path)] >> np.uint64(64 - BUCKET_BITS))
    if not docs:
        empty = np.empty(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty
    return np.concatenate(docs), np.concatenate(places), np.concatenate(paths), np.concatenate(buckets).astype(np.int64)


def repeated(doc: np.ndarray, place: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Which leaves lie under a node together with an earlier one: smaller document, or same document and earlier place."""
    if not len(doc):
        return np.zeros(0, bool)
    order = np.lexsort((place, doc, path))
    p, d, q = path[order], doc[order], place[order]
    new = np.concatenate([[True], p[1:] != p[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))
    later = (d != d[first]) | (q != q[first])
    found = np.zeros(len(doc), bool)
    found[order] = later
    return found


def prefix_groups(docs: DataFrame, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For every prefix bucket the first group and the number of groups of its suffixes, and the number of all groups."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for ids, words in _blocks(batches):
            for found in words:
                n = len(found) - window + 1
                if n > 0:
                    prefix = window_hashes(found, min(PREFIX, window))[:n] >> np.uint64(64 - BUCKET_BITS)
                    np.add.at(total, prefix.astype(np.int64), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    # One row per bucket at most, 65,536 in all, whatever the input.
    rows = docs.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for row in rows:
        total[row["bucket"]] = row["n"]
    start, parts, group, held = np.zeros(len(total), np.int64), np.ones(len(total), np.int64), 0, 0
    for b in np.flatnonzero(total).tolist():
        n = int(total[b])
        if n > GROUP_SUFFIXES:  # a longer prefix: its suffixes are dealt on by their whole path
            parts[b] = -(-n // GROUP_SUFFIXES)
            group += held > 0
            start[b], held = group, 0
            group += int(parts[b])
            continue
        if held + n > GROUP_SUFFIXES:
            group, held = group + 1, 0
        start[b], held = group, held + n
    return start, parts, group + 1


def repeated_starts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, first, last): stretches of word positions at which a window starts that also starts earlier."""
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    start, parts, groups = prefix_groups(slim, window)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words in _blocks(batches):
            doc, place, path, bucket = _suffixes(ids, words, window)
            if not len(doc):
                continue
            settled = repeated(doc, place, path)
            group = start[bucket] + (path % parts[bucket].astype(np.uint64)).astype(np.int64)
            # Settled leaves travel in a row of their own, under a group number of their own; of those there are as many as of the
            # others, so their groups grow no larger with the data either.
            group[settled] = -1 - xxhash.xxh3_64_intdigest(int(ids[0]).to_bytes(8, "little", signed=True)) % groups
            order = np.lexsort((place, doc, group))
            key = group[order]
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])).tolist() + [len(key)]
            rows = [(int(key[a]), order[a:b]) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array([g for g, _ in rows], pa.int64()),
                pa.array([pack_places(doc[i], place[i]) for _, i in rows], pa.binary()),
                pa.array([b"" if g < 0 else planes(path[i])[:PATH_BYTES * len(i)] for g, i in rows], pa.binary()),
            ], names=["group", "places", "paths"])

    def subtree(key: tuple, table: pa.Table) -> pa.Table:
        parts = [unpack_places(x) for x in table["places"].to_pylist()]
        doc, place = (np.concatenate(x) for x in zip(*parts))
        if key[0].as_py() >= 0:
            path = np.concatenate([from_planes(x, PATH_BYTES) for x in table["paths"].to_pylist()])
            later = repeated(doc, place, path)
            doc, place = doc[later], place[later]
        first, last = stretches(doc, place)
        return pa.table([pa.array(doc[first]), pa.array(place[first].astype(np.int32)), pa.array(place[last].astype(np.int32))],
                        names=["doc_id", "first", "last"])

    dealt = slim.mapInArrow(deal, "group long, places binary, paths binary")
    return dealt.groupBy("group").applyInArrow(subtree, "doc_id long, first int, last int")


def stretches(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first and last of each run of adjacent places, of leaves in order of document and place."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > 1)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(doc))[:len(first)] - 1


def planes(values: np.ndarray) -> bytes:
    """Numbers with their bytes laid out by significance, the highest plane first; small numbers then compress well."""
    size = values.dtype.itemsize
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, size)[:, ::-1].T).tobytes()


def from_planes(data: bytes, size: int = 8) -> np.ndarray:
    """The numbers of `planes`, of which the `size` highest bytes were kept."""
    found = np.frombuffer(data, np.uint8).reshape(size, -1)
    wide = np.zeros((found.shape[1], 8), np.uint8)
    wide[:, 8 - size:] = found[::-1].T
    return wide.view(np.uint64).ravel()


def pack_places(doc: np.ndarray, place: np.ndarray) -> bytes:
    """Leaves in order of document and place: each document with its number of leaves, then each place as the distance from the
    one before in its document."""
    cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    step = np.diff(place, prepend=0)
    step[cuts] = place[cuts]
    count = np.diff(np.append(cuts, len(doc)))
    return len(cuts).to_bytes(8, "little") + planes(doc[cuts].view(np.uint64)) + planes(count.astype(np.uint64)) + planes(step.astype(np.uint64))


def unpack_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    docs, count = (from_planes(data[8 + 8 * n * k:8 + 8 * n * (k + 1)]).view(np.int64) for k in range(2))
    total = np.cumsum(from_planes(data[8 + 16 * n:]).view(np.int64))
    start = np.cumsum(count) - count
    before = np.concatenate([[0], total])[start]
    return np.repeat(docs, count), total - np.repeat(before, count)


def covered(first: np.ndarray, last: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of n words lie in a window that starts in one of the stretches."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(first, n), 1)
    np.add.at(edge, np.minimum(last + window, n), -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Per document doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one blank) and, with `with_text`,
    the kept words themselves.

    A word goes if it lies in a window of `window` words that also starts earlier: in a document of smaller doc_id, or
    earlier in the same one. Null and empty texts have no words. Rows with a null doc_id are kept whole and
    take nothing from others. Rows that share a doc_id are one document's: equal texts lose the same words,
    and where their texts differ a place removed in one is removed in all. Other columns are ignored.
    """
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    starts = repeated_starts(slim, window).groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("first", "last")).alias("places"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = []
            for text, places in zip(as_bytes(batch.column(1)), batch.column(2)):
                words = text.split()
                gone = np.zeros(len(words), bool)
                if places.is_valid:
                    first, last = (x.to_numpy().astype(np.int64) for x in places.values.flatten())
                    gone = covered(first, last, window, len(words))
                kept = b" ".join([w for w, x in zip(words, gone.tolist()) if not x]) if gone.any() else b" ".join(words)
                rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if with_text else None))
            n, removed, digest, kept = zip(*rows) if rows else ((), (), (), ())
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(kept, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    joined = slim.join(starts, F.col("doc_id") == F.col("of"), "left").select("doc_id", "text", "places")
    return joined.mapInArrow(run, schema)
