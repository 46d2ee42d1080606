"""Helpers shared by the corpus operators: words, hashed words, bounded batches, stored tables.

A *word* is a run of characters other than blank and the controls 0x09 to 0x0D. On UTF-8 bytes this is
exactly what `bytes.split()` yields, and `bytes.lower()` touches A-Z alone, so the operators work on the
bytes Arrow delivers and never decode a text only to cut it up.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import fresh_path, tune

ROWS_AT_ONCE = 512
CACHE_ENTRIES = 400_000


class Hashes(dict):
    """64-bit hash of a word, computed once per word and task. Emptied when full, so memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for every run of `width` consecutive words; empty if there are fewer words.

    Doubling: hashes of 2, 4, 8, ... words are combined, and the remaining words added at the end.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    size, part = 1, hashes
    total, covered = None, 0
    rest = width
    while rest:
        if rest & 1:
            piece = part[covered:covered + n]
            total = piece if total is None else mix(total * np.uint64(0x9E3779B97F4A7C15) + piece)
            covered += size
        rest >>= 1
        if rest:
            part = mix(part[:-size] * np.uint64(0xD6E8FEB86659FD93) + part[size:])
            size *= 2
    return mix(total + np.uint64(width))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the BIGINT of the same bits."""
    return np.ascontiguousarray(x).view(np.int64)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that what a step derives from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, and with the folder the library was imported from on the path of new Python
    workers (where the library is installed on the cluster, this changes nothing)."""
    context, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return tune(spark)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet to a new path in the shared folder and read it back: lineage is cut there, and
    later branches read only the columns they need."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once: the optimizer never copies a lambda's argument."""
    return F.transform(F.array(value), use)[0]


def native_words(text: Column) -> Column:
    """The words of a text as an array, without Python; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
