"""Multidimensional sharding along a Hilbert curve, in DataFrame functions only.

Several metadata columns are quantised to a few bits each, every row takes the index of its cell on the
Hilbert curve through them, and the rows in curve order are cut into runs of equal count. Cells that are near on
the curve are near in every dimension, so the minima and maxima of a shard's files are narrow in all of them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.ordering import number_rows

BITS = 5
ACCURACY = 2000


def string_code(text: Column) -> Column:
    """The first seven bytes as a number, so that codes order as the strings do; null first."""
    head = F.substring(F.encode(text, "UTF-8"), 1, 7)
    return F.coalesce(F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("double"), F.lit(-1.0))


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Position on the Hilbert curve of the cell with these coordinates, each in [0, 2^bits).

    The published transform from axes to the transposed index: from the highest bit down, each axis either
    inverts the low bits of the first axis or exchanges them with it; then a Gray code; then the bits of all axes
    are interleaved.
    """
    n = len(axes)
    steps = F.array(*(F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)))

    def turn(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        low, at = q - 1, F.get(x, i)
        inverts = at.bitwiseAND(q) != 0
        t = F.when(inverts, low).otherwise(F.get(x, F.lit(0)).bitwiseXOR(at).bitwiseAND(low))
        moved = F.transform(x, lambda v, j: F.when((j == 0) | (~inverts & (j == i)), v.bitwiseXOR(t)).otherwise(v))
        return F.when((i == 0) & ~inverts, x).otherwise(moved)

    turned = F.aggregate(steps, F.array(*(a.cast("int") for a in axes)), turn)

    def gray(x: Column) -> Column:
        coded = [F.get(x, F.lit(0))]
        for i in range(1, n):
            coded.append(coded[-1].bitwiseXOR(F.get(x, F.lit(i))))
        return F.array(*coded)

    def undo(x: Column) -> Column:
        t = F.lit(0)
        for b in range(bits - 1, 0, -1):
            t = F.when(F.get(x, F.lit(n - 1)).bitwiseAND(F.lit(1 << b)) != 0, t.bitwiseXOR(F.lit((1 << b) - 1))).otherwise(t)
        return F.array(t, *(F.get(x, F.lit(i)) for i in range(n)))

    def interleave(x: Column) -> Column:
        index = F.lit(0).cast("long")
        for b in range(bits - 1, -1, -1):
            for i in range(n):
                bit = F.shiftright(F.get(x, F.lit(i + 1)).bitwiseXOR(F.get(x, F.lit(0))), b).bitwiseAND(F.lit(1))
                index = index * 2 + bit
        return index

    def chain(value: Column, *uses) -> Column:
        for use in uses:
            value = F.transform(value, use)
        return value[0]

    return chain(F.array(turned), gray, undo, interleave)


def quantised(df: DataFrame, dimensions: Mapping[str, Column], bits: int = BITS) -> list[Column]:
    """Each dimension cut at its quantiles over all rows, into at most 2^bits cells; null is the lowest."""
    cells = 1 << bits
    marks = [i / cells for i in range(1, cells)]
    cuts = df.select(*(F.percentile_approx(c.cast("double"), marks, ACCURACY).alias(name) for name, c in dimensions.items())).first()

    def cell(value: Column, edges: list[float]) -> Column:
        if not edges:
            return F.lit(0)
        return F.coalesce(F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge <= value)), F.lit(0))

    return [cell(c.cast("double"), sorted(set(cuts[name] or ()))) for name, c in dimensions.items()]


def hilbert_shards(df: DataFrame, dimensions: Mapping[str, Column], order: list[Column], shards: int,
                   bits: int = BITS) -> DataFrame:
    """`df` with `curve` (position on the Hilbert curve), `shard` (0 to shards-1) and `slot` (0, 1, ... in a shard).

    `dimensions` name the columns to cluster by and `order` breaks ties inside a cell; a cell with any share
    of the rows is spread over range partitions by it. Counts of any two shards differ by one at most. Nulls form
    the lowest cell of a dimension, equal rows are placed next to each other, fewer rows than shards leave shards empty,
    and an empty table stays empty. A `df` that has one of the three new columns is refused.
    """
    taken = {"curve", "shard", "slot"} & set(df.columns)
    if taken:
        raise ValueError(f"the table has columns named {', '.join(sorted(taken))} already")
    placed = number_rows(df.withColumn("curve", hilbert_index(quantised(df, dimensions, bits), bits)),
                         [F.col("curve"), *order])
    before = F.col("row_number") - 1
    shard = F.expr(f"(row_number - 1) * {shards} div row_count")
    first = F.expr(f"((row_number - 1) * {shards} div row_count * row_count + {shards - 1}) div {shards}")
    return placed.select(*(c for c in placed.columns if c not in ("row_number", "row_count")),
                         shard.cast("int").alias("shard"), (before - first).alias("slot"))


def document_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Documents in `shards` runs of the Hilbert curve through lang, source, size and doc_id.

    Returns doc_id, size (UTF-8 bytes of the text, none for null, plus 8), text_crc32, law, shard, slot, grown_shard
    (null: the law `rows` keeps counts at most one apart, and one more shard would move rows), curve. A null doc_id, lang
    or source is the lowest cell of its dimension. Further columns of `docs` are ignored.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    slim = docs.select("doc_id", F.octet_length(text).cast("long").alias("octets"), F.crc32(text).alias("text_crc32"),
                       string_code(F.col("lang")).alias("lang_code"), string_code(F.col("source")).alias("source_code"))
    slim = slim.withColumn("size", F.col("octets") + 8)
    dimensions = {"lang_code": F.col("lang_code"), "source_code": F.col("source_code"),
                  "size": F.col("size"), "doc_id": F.col("doc_id")}
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    cut = hilbert_shards(slim, dimensions, order, shards)
    return cut.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "curve")
