"""Divergence between the sources of a language: how far their term frequencies lie apart, in exact integers.

Texts are cut into terms and counted per task; Spark sums the counts and keeps, in each language, the terms of enough documents.
A kept term of a group (lang, source) is then no more than a cell of two numbers, its count in the group and in the
language: the difference of the two frequencies is worked out once per cell, equal differences are merged, the best of them
are found by the cumulative number of their terms, and only those are expanded into terms.

Sources are compared in blocks of terms: a block holds the frequencies of all sources of a language for some of its terms,
as a matrix of bounded size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.llm.common import as_bytes, small_batches, stored

LEAST_DOCUMENTS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP = 50
TERMS_HELD = 200_000  # terms a task holds before it passes their counts on
BLOCK_CELLS = 50_000  # aimed at: frequencies in a block of terms
TILE_SOURCES = 256  # aimed at: sources in a tile

# What separates terms becomes a blank and A-Z small letters; all else stays, above all every byte of a character beyond ASCII.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs: occurrences and documents of each term in each group."""
    schema = "lang string, source string, term string, count long, docs long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (count, found) in groups.items():
                n = len(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.binary()).cast(pa.string()), pa.array([source] * n, pa.binary()).cast(pa.string()),
                     pa.array(list(count), pa.binary()).cast(pa.string()), pa.array(list(count.values()), pa.int64()),
                     pa.array([found[t] for t in count], pa.int64())],
                    names=["lang", "source", "term", "count", "docs"])
            groups.clear()

        for batch in small_batches(batches):
            for lang, source, text in zip(*(as_bytes(batch.column(i)) for i in range(3))):
                terms = text.translate(LETTERS).split()
                if terms:
                    count, found = groups.setdefault((lang, source), (Counter(), Counter()))
                    count.update(terms)
                    found.update(set(terms))
            if sum(len(count) for count, _ in groups.values()) > TERMS_HELD:
                yield from passed_on()
        yield from passed_on()

    return docs.select("lang", "source", "text").mapInArrow(run, schema)


def frequency(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 5) / (total + 5 * terms)), without overflow. Where there are no terms, no term asks for it."""
    wide = lambda c: c.cast("decimal(20,0)")
    whole = F.greatest(total + SMOOTHING * terms, F.lit(1))
    return (F.lit(1) + F.call_function("div", wide(count + SMOOTHING) * F.lit(UNIT), wide(whole))).cast("long")


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, term, count, lang_count, first (true in one row of each term of a language) of the terms that at least
    `least` documents of the language hold. Both sums need one shuffle, by language and term."""
    sums = term_counts(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    term = W.partitionBy("lang", "term")
    whole = sums.select("lang", "source", "term", "count", F.sum("count").over(term).alias("lang_count"),
                        F.sum("docs").over(term).alias("lang_docs"), F.min("source").over(term).alias("least_source"))
    return whole.where(F.col("lang_docs") >= least).select(
        "lang", "source", "term", "count", "lang_count", (F.col("source") == F.col("least_source")).alias("first"))


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total, lang_total, terms, sources: one row for each group that occurs, with the sums of kept terms."""
    names = docs.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count(F.when(F.col("first"), 1)).alias("firsts"))
    joined = names.join(own, ["lang", "source"], "left").select(
        "lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "firsts")))
    lang = joined.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("terms"), F.count("*").alias("sources"))
    return joined.drop("firsts").join(lang, "lang")


def top_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank of the terms that a group uses more than its language, up to rank `top`."""
    cells = kept.groupBy("lang", "source", "count", "lang_count").agg(F.count("*").alias("terms_here"))
    valued = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "count", "lang_count", "terms_here",
        (frequency(F.col("count"), F.col("total"), F.col("terms"))
         - frequency(F.col("lang_count"), F.col("lang_total"), F.col("terms"))).alias("value")).where("value > 0")
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("terms_here").alias("terms_here"))
    group = W.partitionBy("lang", "source")
    # Every value has a term at least, so the `top` best values of a group hold its `top` best terms; tasks pass on no more.
    best = merged.withColumn("place", F.row_number().over(group.orderBy(F.desc("value")))).where(F.col("place") <= top)
    before = F.coalesce(F.sum("terms_here").over(group.orderBy(F.desc("value")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    reached = best.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    chosen = valued.join(reached, ["lang", "source", "value"]).select("lang", "source", "count", "lang_count", "value", "before")
    items = kept.select("lang", "source", "count", "lang_count", F.col("term").alias("item")).join(
        chosen, ["lang", "source", "count", "lang_count"])
    alike = W.partitionBy("lang", "source", "value").orderBy("item")
    placed = items.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= top)
    return placed.withColumn("rank", F.col("before") + F.col("place")).where(F.col("rank") <= top).select(
        "lang", "source", "item", "value", "rank")


def _distances(rows: pd.DataFrame) -> pd.DataFrame:
    """For each pair of a source of tile a and one of tile b: the sum of |p - q| over the terms of this block that a source of the
    two tiles has, less `gap` for each, the difference of the two where both lack the term."""
    seats = rows[rows["term"].isna()].sort_values("source", kind="stable")
    place = {s: i for i, s in enumerate(seats["source"])}
    found = rows[rows["term"].notna()]
    columns, terms = pd.factorize(found["term"])
    lacking = seats["p"].to_numpy(np.int64)
    p = np.repeat(lacking[:, None], len(terms), axis=1)
    p[found["source"].map(place).to_numpy(np.int64), columns] = found["p"].to_numpy(np.int64)
    own = seats["tile"].to_numpy(np.int64)
    tile_a, tile_b = int(rows["tile_a"].iloc[0]), int(rows["tile_b"].iloc[0])
    a_rows, b_rows = np.flatnonzero(own == tile_a), np.flatnonzero(own == tile_b)
    names = seats["source"].to_numpy(object)
    parts = [pd.DataFrame({"lang": pd.Series(dtype=object), "a": pd.Series(dtype=object), "b": pd.Series(dtype=object),
                           "gap": pd.Series(dtype="int64"), "value": pd.Series(dtype="int64")})]
    for i in a_rows:
        others = b_rows[b_rows > i] if tile_a == tile_b else b_rows
        if len(others):
            gap = np.abs(lacking[others] - lacking[i])
            parts.append(pd.DataFrame({"lang": rows["lang"].iloc[0], "a": names[i], "b": names[others], "gap": gap,
                                       "value": np.abs(p[others] - p[i]).sum(1) - gap * len(terms)}))
    return pd.concat(parts)


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: each other source of the language, by its distance over all kept terms.

    The terms of a language are dealt into blocks of about BLOCK_CELLS frequencies, its sources into tiles of about
    TILE_SOURCES, so a task holds two tiles and a block whatever the size. Every source has a seat in every block, with the
    frequency of a term it lacks.
    """
    shape = groups.select(
        "lang", "source", "total", "terms",
        F.greatest(F.lit(1), F.ceil(F.col("terms") * F.least(F.col("sources"), F.lit(2 * TILE_SOURCES)) / BLOCK_CELLS)).cast("int").alias("blocks"),
        F.ceil(F.col("sources") / TILE_SOURCES).cast("int").alias("tiles"))
    shape = shape.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    p = frequency(F.col("count"), F.col("total"), F.col("terms")).alias("p")
    seats = shape.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "source", "tile", "tiles", "block", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("count"), "total", "terms")
    placed = kept.join(shape, ["lang", "source"]).select(
        "lang", "source", "tile", "tiles", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "term", "count", "total", "terms")
    both = seats.unionByName(placed).select("lang", "source", "tile", "tiles", "block", "term", p)
    dealt = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "lang", "source", "tile", "block", "term", "p", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"))
    parts = dealt.groupBy("lang", "block", "tile_a", "tile_b").applyInPandas(_distances, "lang string, a string, b string, gap long, value long")
    terms = groups.groupBy("lang").agg(F.max("terms").alias("terms"))
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.max("gap").alias("gap")).join(terms, "lang").select(
        "lang", "a", "b", (F.col("value") + F.col("gap") * F.col("terms")).alias("value"))
    both_ways = sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionAll(
        sums.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return both_ways.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank of every group (lang, source).

    Null text, lang and source count as empty. A text without terms only makes its group occur; a language without kept terms
    has pairs of value 0 and no terms; a group that is alone in its language has no pairs. Repeated rows count each, equal
    values are ranked by item in UTF-8 order, an empty table gives no row. Columns beyond text, lang and source are not read.
    """
    named = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = stored(kept_terms(named, least), "kept-terms")
    groups = stored(groups_of(named, kept), "groups")
    pairs = source_pairs(kept, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.col("rank").cast("int"))
    terms = top_terms(kept, groups, top).select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int"))
    return pairs.unionByName(terms)
