"""Benchmark decontamination by SimHash windows.

Every benchmark item gets a 64-bit SimHash of its word shingles, and so does every window of that size in every
document. The fingerprint is cut into blocks; if two fingerprints differ in at most RADIUS bits, they differ in at most
RADIUS // BLOCKS bits in one block at least, so looking up every block value near an item's own finds all windows within the
radius. A block value leads to the items that have one near it, so a window is compared with those alone. What is found is
verified by the exact weighted similarity of the shingles.

An edited copy may differ in more bits, or in the words that a shorter window leaves out. So every window of an item's own
length that holds one of the item's rare shingles, a fifth of its weight, is compared as well: without all of these a window
cannot have the similarity.

Documents are read once for each part and not shuffled. Weights come from the whole benchmark, which goes to the tasks in parts of
bounded size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import CACHE_ENTRIES, ROWS_AT_ONCE, as_bytes, small_batches, stored, window_hashes
from shelfmark.operators.ordering import number_rows

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 4
BLOCK_BITS = 16
RADIUS = 11
SIZE_STEP = 5  # windows are at most a fifth shorter than their item
ITEM_WORDS_AT_ONCE = 200_000
SEGMENT_WORDS = 100_000
TILE = 4096
ROUNDING = 1e-9  # sums of weights may differ by less

EDGE = re.compile(r"^[\W_]+|[\W_]+$")


class PlainWords(dict):
    """Hash of a word in lower case without punctuation around it; 0 if nothing is left. Emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if word.isalnum():  # ASCII letters and digits only
            bare = word.lower()
        else:
            bare = EDGE.sub("", word.decode("utf-8", "surrogatepass").lower()).encode("utf-8", "surrogatepass")
        value = self[word] = (xxhash.xxh3_64_intdigest(bare) | 1) if bare else 0
        return value

    def of(self, text: bytes) -> np.ndarray:
        words = text.split()
        found = np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
        return found if found.all() else found[found != 0]


@lru_cache(maxsize=1)
def worker_words() -> PlainWords:
    return PlainWords()


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of SHINGLE words; a shorter text is one shingle."""
    return window_hashes(words, min(SHINGLE, len(words))) if len(words) else words


def counters(shingle: np.ndarray) -> np.ndarray:
    """For every prefix of the shingles how many of them set each bit.

    The 64 bit counters of a prefix lie in eight 64-bit numbers, eight to each. Carries between them cancel in the
    difference of two prefixes as long as a run has fewer than 256 shingles; longer runs add up parts.
    """
    lanes = np.unpackbits(np.ascontiguousarray(shingle).view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
    prefix = np.zeros((len(shingle) + 1, 8), np.uint64)
    np.cumsum(lanes, axis=0, out=prefix[1:])
    return prefix


def fingerprints(prefix: np.ndarray, count: int) -> np.ndarray:
    """SimHash of every run of `count` shingles, from their counters. A bit is set if more than half of the run sets it."""
    n = len(prefix) - count
    if n <= 0:
        return np.empty(0, np.uint64)
    return np.concatenate([_signs(prefix, at, min(TILE, n - at), count) for at in range(0, n, TILE)])


def _signs(prefix: np.ndarray, at: int, n: int, count: int) -> np.ndarray:
    if count < 256:
        sums = (prefix[at + count:at + count + n] - prefix[at:at + n]).view(np.uint8)
    else:
        steps = [*range(0, count, 255), count]
        sums = sum((prefix[at + b:at + b + n] - prefix[at + a:at + a + n]).view(np.uint8).astype(np.uint32)
                   for a, b in zip(steps, steps[1:]))
    return np.packbits(sums > count // 2, axis=1).view(np.uint64).ravel()


def near_values(value: int, radius: int, bits: int = BLOCK_BITS) -> list[int]:
    """All block values within `radius` bits of one."""
    return [reduce(lambda v, b: v ^ (1 << b), flips, value) for r in range(radius + 1) for flips in combinations(range(bits), r)]


@dataclass
class Size:
    """The items that windows of `words` words are compared with."""

    words: int
    items: np.ndarray
    prints: np.ndarray
    near: np.ndarray  # block number, block value -> whether some item has a value near it there

    def __post_init__(self) -> None:
        # For each block: the start of a value's items in `members`, how many they are, and the items.
        masks = np.array(near_values(0, RADIUS // BLOCKS), np.uint16)
        self.lists = []
        for row in self.prints.view(np.uint16).reshape(-1, BLOCKS).T:
            pairs = (row[:, None] ^ masks[None]).ravel()
            count = np.bincount(pairs, minlength=1 << BLOCK_BITS).astype(np.int32)
            members = (np.argsort(pairs, kind="stable") // len(masks)).astype(np.int32)
            self.lists.append(((np.cumsum(count) - count).astype(np.int32), count, members))

    def candidates(self, prints: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(block, windows, places of items) that have near values in the block. Only these are compared: of unlike fingerprints
        one pair in 480 a block."""
        parts = prints.view(np.uint16).reshape(-1, BLOCKS)
        for b, (starts, counts, members) in enumerate(self.lists):
            hit = np.flatnonzero(self.near[b][parts[:, b]])
            for i in range(0, len(hit), TILE):
                at = hit[i:i + TILE]
                value = parts[at, b]
                count = counts[value]
                before = np.cumsum(count) - count
                yield b, np.repeat(at, count), members[np.arange(count.sum()) + np.repeat(starts[value] - before, count)]

    def hits(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius."""
        found = []
        for block, at, place in self.candidates(prints):
            differing = prints[at] ^ self.prints[place]
            distance = np.bitwise_count(differing)
            close = np.flatnonzero(distance <= RADIUS)
            earlier = np.bitwise_count(differing[close].view(np.uint16).reshape(-1, BLOCKS)[:, :block])
            close = close[(earlier > RADIUS // BLOCKS).all(1)]  # the others were found in an earlier block
            found.append((at[close], self.items[place[close]], distance[close]))
        empty = np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (empty, empty, empty)


class Benchmark:
    """Items as shingle counts and fingerprints, by window size.

    `total` is the number of items of the whole benchmark and `frequency` in how many of them a shingle is found; of a part of
    a benchmark they must be those of the whole, so that an item has the same weights in any part. Without them the items are the whole.
    """

    def __init__(self, items: Sequence[tuple[int, np.ndarray]], total: int | None = None, frequency: dict[int, int] | None = None) -> None:
        self.items = [(i, words) for i, words in items if len(words)]
        self.counts = [Counter(shingles(w).tolist()) for _, w in self.items]
        self.total = len(self.items) if total is None else total
        self.frequency = Counter(s for c in self.counts for s in c) if frequency is None else frequency
        grid = [1]
        while self.items and grid[-1] < max(len(w) for _, w in self.items):
            grid.append(max(grid[-1] + 1, grid[-1] + grid[-1] // SIZE_STEP))
        by_size: dict[int, list[int]] = {}
        for k, (_, words) in enumerate(self.items):
            by_size.setdefault(max(g for g in grid if g <= len(words)), []).append(k)
        self.sizes = [self._size(words, members) for words, members in sorted(by_size.items())]
        self.prints = [_print(shingles(w)) for _, w in self.items]
        self.rare = self._rare()
        self.rare_hashes = np.sort(np.fromiter(self.rare, np.uint64, len(self.rare)))
        self.rare_ends = np.zeros(1 << BLOCK_BITS, bool)
        self.rare_ends[self.rare_hashes.astype(np.uint16)] = True

    def _rare(self) -> dict[int, list[int]]:
        """By shingle the items that have it among their rarest, which make up more than the weight a similar window may lack.
        Items of fewer than SHINGLE words are found by their fingerprint or not at all."""
        found: dict[int, list[int]] = {}
        for k, (_, words) in enumerate(self.items):
            if len(words) < SHINGLE:
                continue
            lacking = (1 - SIMILARITY) * self.size_of(k) + ROUNDING
            for s in sorted(self.counts[k], key=lambda s: (self.frequency[s], s)):
                found.setdefault(s, []).append(k)
                lacking -= self.counts[k][s] * self.weight(s)
                if lacking < 0:
                    break
        return found

    def size_of(self, item: int) -> float:
        """The weighted size of an item's bag of shingles."""
        return sum(n * self.weight(s) for s, n in self.counts[item].items())

    def _size(self, words: int, members: list[int]) -> Size:
        prints = np.array([fingerprints(counters(shingles(self.items[k][1][:words])), self.run(words))[0] for k in members], np.uint64)
        near = np.zeros((BLOCKS, 1 << BLOCK_BITS), bool)
        for b, row in enumerate(prints.view(np.uint16).reshape(-1, BLOCKS).T):
            for value in set(row.tolist()):
                near[b, near_values(value, RADIUS // BLOCKS)] = True
        return Size(words, np.array(members), prints, near)

    @staticmethod
    def run(words: int) -> int:
        """Shingles in so many words."""
        return max(1, words - SHINGLE + 1)

    def weight(self, shingle: int) -> float:
        """Shingles that many items share say less."""
        return 1.0 + float(np.log((1 + self.total) / (1 + self.frequency.get(shingle, 0))))

    def similarity(self, item: int, words: np.ndarray) -> float:
        """Weighted sizes of the intersection and union of two bags of shingles."""
        ours, theirs = self.counts[item], Counter(shingles(words).tolist())
        both = either = 0.0
        for s in ours.keys() | theirs.keys():
            a, b, w = ours.get(s, 0), theirs.get(s, 0), self.weight(s)
            both += w * min(a, b)
            either += w * max(a, b)
        return both / either

    def rare_places(self, owner: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Where a rare shingle of some item starts, among words of several documents."""
        if len(words) < SHINGLE:
            return np.empty(0, np.int64)
        found = window_hashes(words, SHINGLE)
        at = np.flatnonzero(self.rare_ends[found.astype(np.uint16)])
        at = at[np.isin(found[at], self.rare_hashes)]
        return at[owner[at] == owner[at + SHINGLE - 1]]

    def windows(self, item: int, words: np.ndarray, places: Sequence[int]) -> Iterator[tuple[float, int]]:
        """(most similarity possible, start) of the windows that hold one of `places` and may be similar, likeliest first."""
        length, own, size = len(self.items[item][1]), self.counts[item], self.size_of(item)
        run, places, found = self.run(min(length, len(words))), sorted(set(places)), []
        groups = np.split(np.array(places), np.flatnonzero(np.diff(places) > length) + 1)
        for group in groups:
            low, high = max(0, int(group[0]) - run + 1), min(len(words), int(group[-1]) + run + SHINGLE - 1)
            inside = window_hashes(words[low:high], SHINGLE).tolist()
            weights = np.array([self.weight(s) for s in inside])
            shared = np.where([s in own for s in inside], weights, 0)
            total, both = (np.concatenate([[0], np.cumsum(x)]) for x in (weights, shared))
            total, both = total[run:] - total[:-run], both[run:] - both[:-run]
            both = np.minimum(both, size)
            most = both / (size + total - both)
            at = np.flatnonzero(most >= SIMILARITY - ROUNDING)
            found.extend(zip(most[at].tolist(), (low + at).tolist()))
        yield from sorted(set(found), key=lambda x: (-x[0], x[1]))

    def search(self, docs: Sequence[np.ndarray]) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(document, item number, first word, words, distance, similarity) of the best window of each similar pair."""
        best: dict[tuple[int, int], tuple] = {}
        places: dict[tuple[int, int], list[int]] = {}
        longest = max((len(w) for _, w in self.items), default=0)
        tried: set[tuple[int, int, int]] = set()

        def compare(doc: int, item: int, start: int) -> None:
            if (doc, item, start) in tried:
                return
            tried.add((doc, item, start))
            window = docs[doc][start:start + len(self.items[item][1])]
            like = self.similarity(item, window)
            if like >= SIMILARITY:
                row = (-like, start, len(window), int(np.bitwise_count(_print(shingles(window)) ^ self.prints[item])))
                best[doc, item] = min(best.get((doc, item), row), row)

        for owner, base, words in _segments(docs, longest):
            single = {}
            for at in self.rare_places(owner, words).tolist():
                doc = int(owner[at])
                for item in self.rare[int(window_hashes(words[at:at + SHINGLE], SHINGLE)[0])]:
                    places.setdefault((doc, item), []).append(base[doc] + at)
            for size in self.sizes:
                width = min(SHINGLE, size.words)
                if width not in single:
                    single[width] = counters(window_hashes(words, width))
                prints = fingerprints(single[width], self.run(size.words))
                whole = owner[:len(prints)] == owner[size.words - 1:size.words - 1 + len(prints)]
                for at, item, _ in zip(*(x.tolist() for x in size.hits(prints))):
                    if not whole[at]:
                        continue
                    doc = int(owner[at])
                    compare(doc, item, max(0, min(base[doc] + at, len(docs[doc]) - len(self.items[item][1]))))
        for (doc, item), found in places.items():
            for most, start in self.windows(item, docs[doc], found):
                if (doc, item) in best and most < -best[doc, item][0] - ROUNDING:
                    break
                compare(doc, item, start)
        for (doc, item), (like, start, words, distance) in sorted(best.items()):
            yield doc, self.items[item][0], start, words, distance, -like


def _print(shingle: np.ndarray) -> np.uint64:
    """SimHash of all of the shingles."""
    return fingerprints(counters(shingle), len(shingle))[0]


def _segments(docs: Sequence[np.ndarray], overlap: int):
    """Words of several documents side by side, at most about SEGMENT_WORDS of them; a longer document is cut into parts
    that overlap by an item. With them the document of every word, and what to add for its place in the document."""
    words, owner, base, held = [], [], {}, 0

    def segment():
        return np.concatenate(owner), dict(base), np.concatenate(words)

    for d, doc in enumerate(docs):
        for start in range(0, max(1, len(doc) - overlap), SEGMENT_WORDS):
            part = doc[start:start + SEGMENT_WORDS + overlap]
            if not len(part):
                continue
            if held and held + len(part) > SEGMENT_WORDS or d in base:
                yield segment()
                words, owner, base, held = [], [], {}, 0
            base[d] = start - held
            words.append(part)
            owner.append(np.full(len(part), d, np.int32))
            held += len(part)
    if held:
        yield segment()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item where a window of the document has the item's shingles with a weighted
    similarity of SIMILARITY or more: doc_id, item_id, start and n_words of the best window (in words that hold a
    letter or digit), hamming (between the fingerprints of item and window), similarity.

    Null and empty texts and items, and items without such words, match nothing. A repeated document row gives its rows
    again, a repeated item too. Items of fewer than SHINGLE words count as one shingle. Columns beyond doc_id and text,
    item_id and text are ignored; either table may be empty.
    """
    schema = "doc_id long, item_id long, start long, n_words long, hamming int, similarity double"
    slim = docs.select(docs["doc_id"].cast("long"), docs["text"])
    found = None
    for part in _parts(benchmark):
        rows = _search(slim, part, schema)
        found = rows if found is None else found.unionAll(rows)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def prepared(benchmark: DataFrame, at_once: int) -> DataFrame:
    """The items that have words, stored: part, item_id, words, shingles, frequencies (of each shingle, among all items). Parts follow
    item_id and hold about `at_once` words each, an item whole."""
    spark = benchmark.sparkSession

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = PlainWords()
        for batch in small_batches(batches):
            words = [plain.of(t) for t in as_bytes(batch.column(1))]
            kinds = [np.unique(shingles(w)) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64())),
                 pa.array([k.view(np.int64) for k in kinds], pa.list_(pa.int64()))], names=["item_id", "n_words", "words", "kinds"])

    coded = benchmark.select(benchmark["item_id"].cast("long"), benchmark["text"]).mapInArrow(
        code, "item_id long, n_words long, words array<long>, kinds array<long>").where("n_words > 0")
    items = stored(coded.withColumn("row", F.monotonically_increasing_id()), "items")
    places = items.select("row", F.explode("kinds").alias("shingle"))
    frequency = places.groupBy("shingle").agg(F.count("*").alias("found"))
    known = places.join(frequency, "shingle").groupBy("row").agg(F.collect_list(F.struct("shingle", "found")).alias("known"))
    order = [F.col("item_id").asc_nulls_first(), F.col("row")]
    parted = number_rows(items.select("item_id", "row", "n_words"), order, ["n_words"]).select(
        "row", F.expr(f"(running_n_words - n_words) div {at_once}").cast("int").alias("part"), F.col("row_count").alias("total"))
    return stored(items.join(parted, "row").join(known, "row").select(
        "part", "total", "item_id", "row", "words", F.col("known.shingle").alias("shingles"), F.col("known.found").alias("frequencies")), "benchmark")


def _parts(benchmark: DataFrame, at_once: int | None = None) -> Iterator[Benchmark]:
    """The items in parts of ITEM_WORDS_AT_ONCE words, so that what a task is sent has a bound; each part is one more read of
    the documents. Weights are those of the whole benchmark, so the parts change no result."""
    items = prepared(benchmark, at_once or ITEM_WORDS_AT_ONCE)
    last = items.agg(F.max("part")).first()[0]
    for part in range(-1 if last is None else last, -1, -1):
        rows = items.where(F.col("part") == part).orderBy("item_id", "row").collect()
        if rows:  # a part is empty where a long item goes beyond it
            frequency = {s % (1 << 64): n for r in rows for s, n in zip(r.shingles, r.frequencies)}
            yield Benchmark([(r.item_id, np.array(r.words, np.int64).view(np.uint64)) for r in rows], rows[0].total, frequency)


def _search(docs: DataFrame, benchmark: Benchmark, schema: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, items = worker_words(), sent.value
        for batch in small_batches(batches):
            ids = batch.column(0).to_pylist()
            rows = [(ids[d], *rest) for d, *rest in items.search([plain.of(t) for t in as_bytes(batch.column(1))])]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "item_id", "start", "n_words", "hamming", "similarity"])

    return docs.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no benchmark item. The texts are judged where they are read."""
    for part in _parts(benchmark):
        docs = docs.where(~_holds(docs, part))
    return docs


def _holds(docs: DataFrame, benchmark: Benchmark) -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(benchmark)

    @F.pandas_udf("boolean")
    def holds(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        plain = worker_words()
        for part in parts:
            found = np.zeros(len(part), bool)
            for at in range(0, len(part), ROWS_AT_ONCE):
                texts = [plain.of((t or "").encode("utf-8", "surrogatepass")) for t in part.iloc[at:at + ROWS_AT_ONCE]]
                found[[at + d for d, *_ in sent.value.search(texts)]] = True
            yield pd.Series(found, index=part.index)

    return holds(docs["text"])
