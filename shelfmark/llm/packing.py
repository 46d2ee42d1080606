"""Packing of documents into windows by best-fit decreasing.

Every task tokenises its documents, cuts overlong ones into full windows and packs the remainders with
best-fit decreasing over the pieces it holds, in turns of bounded size. No token is shuffled, and nothing depends on other tasks, so a
lost task is simply run again. With W tokens a window, a task wastes no more than a few windows however
many pieces it has; windows of different tasks are never shared.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shelfmark.llm.common import small_batches

SEPARATOR = 0
# A task packs the remainders it holds when they are so many, or their ids take so many bytes; counted alike whether or not the
# ids are returned, so both forms pack a table the same way.
PIECES_AT_ONCE = 200_000
BYTES_AT_ONCE = 64_000_000
TASK_SHIFT = 40  # a window's id is its task's number above these bits, and a count below


class OpenWindows:
    """Open windows in a segment tree indexed by remaining capacity.

    Leaf c counts the open windows with exactly c free places and an inner node sums its children, so the
    tightest window that still takes a piece is the leftmost non-empty leaf at or right of its length.
    """

    def __init__(self, capacity: int) -> None:
        self.base = 1
        while self.base <= capacity:
            self.base *= 2
        self.count = [0] * (2 * self.base)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, leaf: int, by: int) -> None:
        node = leaf + self.base
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, window: int, free: int) -> None:
        if free:
            self.windows[free].append(window)
            self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the tightest (window, free places) with at least `need` places."""
        node, count = need + self.base, self.count
        while not count[node]:
            while node & 1:  # a right child: nothing further right under this parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.base:
            node *= 2
            node += not count[node]
        free = node - self.base
        self._add(free, -1)
        return self.windows[free].pop(), free


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each piece its window and its offset there, and the number of windows. Pieces of one length keep
    their order; the longest piece goes first, each into the open window that it fills best."""
    tree, opened = OpenWindows(capacity), 0
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None:
            found, opened = (opened, capacity), opened + 1
        window[i], offset[i] = found[0], capacity - found[1]
        tree.put(found[0], found[1] - need)
    return window, offset, opened


def byte_tokens(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """A byte-level vocabulary keyed by bytes. Its tokens spell printable Latin-1 bytes as themselves and the others, in
    order, as the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items()}


class Encoder:
    """Token ids of a text as little-endian 32-bit bytes, as the `tokenizers` library gives them for a tokenizer file.

    If the file holds a plain byte-level BPE whose ids follow the order of its merges, the same vocabulary also runs in
    `tiktoken`, four times as fast. It takes the texts in characters both libraries' tables agree on; any other
    text, and one that spells a special token, goes to `tokenizers`.
    """

    # Fixed value: how a byte-level BPE of this kind cuts a text before merging.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    UNSURE = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._fast(json.loads(self.tokenizer.to_str()))

    def _fast(self, parts: dict):
        model, cut = parts["model"], parts["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or parts["normalizer"] or model.get("ignore_merges") or model.get("dropout")
                or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex")):
            return None
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in self.special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocabulary[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        import tiktoken

        return tiktoken.Encoding("same", pat_str=self.PATTERN, mergeable_ranks=byte_tokens(vocabulary), special_tokens={})

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if (self.fast is None or any(s in text for s in self.special)
                or not text.isascii() and self.UNSURE.search(text)):
            return self.plain(text)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    return Encoder(path)


COLUMNS = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "ids array<int>")


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, with_ids: bool = True) -> DataFrame:
    """Cut and pack the documents (doc_id, text); one row per piece.

    `start` counts the document's ids before the piece, `ids_crc32` is the CRC-32 of its ids as unsigned
    little-endian 32-bit numbers, `doc_tokens` the document's ids with the separator, `sequence_id` and `offset`
    its place. With `with_ids` the ids themselves follow.

    A null or empty text is one separator. A null doc_id is kept as null, repeated rows are packed each. Other
    columns of `docs` are ignored, and an empty table gives no rows. A text longer than any window is cut at full
    windows, and its remainder is packed like any other piece.
    """
    schema = COLUMNS if with_ids else COLUMNS.rpartition(",")[0]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        task, used = TaskContext.get().partitionId() << TASK_SHIFT, 0

        def rows(pieces: list[tuple], sequence, offset) -> pa.RecordBatch:
            doc, start, length, crc, total, ids = zip(*pieces)
            arrays = [pa.array(doc, pa.int64()), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                      pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def packed(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal used
            where, offset, opened = best_fit_decreasing(np.array([p[2] for p in pieces], np.int64), window)
            for at in range(0, len(pieces), 10_000):
                yield rows(pieces[at:at + 10_000], where[at:at + 10_000] + (task + used), offset[at:at + 10_000])
            used += opened

        short: list[tuple] = []
        held = 0  # bytes of the remainders' ids
        for batch in small_batches(batches, 256):
            full: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text or "") + SEPARATOR.to_bytes(4, "little")
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start:4 * (start + window)]
                    piece = (doc, start, len(part) // 4, zlib.crc32(part), total, part if with_ids else b"")
                    (full if piece[2] == window else short).append(piece)
                    held += len(part) * (piece[2] < window)
            if full:
                yield rows(full, range(task + used, task + used + len(full)), [0] * len(full))
                used += len(full)
            if len(short) >= PIECES_AT_ONCE or held >= BYTES_AT_ONCE:
                yield from packed(short)
                short, held = [], 0
        if short:
            yield from packed(short)

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, schema)
