"""Merkle manifest of a dataset: a root that vouches for all rows, and for each row the proof that leads to it.

Rows become leaves, numbered within their tree without gathering a tree in one task. At every level each node meets its sibling by an
equijoin on the sibling's computed index (the own index XOR 1: runs hold two nodes), and the nodes at slot zero of their run
emit the parents. A level is written before the next one is built, so a lost executor costs one level. The levels are then
walked from the root down, again each written: a node hands its own siblings, from itself to the root, to its children.

A digest is kept as 32 bytes and hashed as its lower-case hex text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored
from shelfmark.operators.ordering import number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 7  # rows whose crc32(doc_id) this divides are tampered with


def sha256_of(*hex_or_text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(c.cast("binary") for c in hex_or_text)), 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and tampered: the digest of the row, and that of the row with 1 added to n_chars where it is tampered
    with (null in all other rows)."""
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *(docs[c] for c in FIELDS[1:]))

    def digest(n_chars: Column) -> Column:
        return sha256_of(*(field(n_chars if c == "n_chars" else F.col(c)) for c in FIELDS))

    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return slim.select("doc_id", "lang", digest(F.col("n_chars")).alias("leaf"),
                       F.when(hit & F.col("n_chars").isNotNull(), digest(F.col("n_chars").cast("long") + 1)).alias("tampered"))


def numbered(df: DataFrame, tree: str | None, order: list[Column]) -> DataFrame:
    """`df` with idx (0, 1, ... within its tree) and size (nodes of the tree), from one global order that keeps trees together."""
    in_tree = [F.col(tree).asc_nulls_first()] if tree else []
    rows = number_rows(df, [*in_tree, *order])
    if not tree:
        return rows.select(*df.columns, (F.col("row_number") - 1).alias("idx"), F.col("row_count").alias("size"))
    trees = rows.groupBy(tree).agg(F.min("row_number").alias("first"), F.count("*").alias("size")).withColumnRenamed(tree, "of")
    # A row per tree; Spark sends it to all tasks where its measured size allows, and splits hot trees where not.
    met = rows.join(trees, F.col(tree).eqNullSafe(F.col("of")))
    return met.select(*df.columns, (F.col("row_number") - F.col("first")).alias("idx"), "size")


def sibling_levels(nodes: DataFrame) -> list[DataFrame]:
    """Levels of all trees from the leaves (tree, idx, size, digest; stored) up, stored: each node with its sibling's digest, null
    where it has none or is the root. A tree is in every level up to the one where it has a single node."""
    largest = nodes.agg(F.max("size")).first()[0] or 1
    levels = []
    for n in range((largest - 1).bit_length() + 1):
        sibling = nodes.select(F.col("tree").alias("of"), F.col("idx").alias("at"), F.col("digest").alias("sibling"))
        shifted = nodes["idx"].bitwiseXOR(F.lit(1).cast("long"))
        level = stored(nodes.join(sibling, nodes["tree"].eqNullSafe(sibling["of"]) & (shifted == sibling["at"]), "left").select(
            "tree", "idx", "size", "digest", "sibling"), f"merkle-{n}")
        levels.append(level)
        slot_zero = level.where((F.col("size") > 1) & (F.col("idx") % 2 == 0))
        parent = F.when(F.col("sibling").isNull(), sha256_of(hex_of(F.col("digest")))).otherwise(
            sha256_of(hex_of(F.col("digest")), hex_of(F.col("sibling"))))
        nodes = slot_zero.select("tree", F.shiftright("idx", 1).alias("idx"),
                                 F.shiftright(F.col("size") + 1, 1).alias("size"), parent.alias("digest"))
    return levels


def step(idx: Column, sibling: Column) -> Column:
    """One step of a proof: the sibling (null: none) and whether it stands to the left."""
    return F.struct((idx % 2 == 1).alias("left"), sibling.alias("sibling"))


def paths(levels: list[DataFrame], roots: DataFrame) -> DataFrame:
    """tree, idx, top, steps of every leaf: the steps from it up to the root of its tree, then those that `roots` (tree, top,
    steps) has for the root, and the root's `top`."""

    above = None
    for n, level in reversed(list(enumerate(levels))):
        own = level.withColumn("is_root", F.col("size") == 1)
        found = own.where("is_root").join(roots.withColumnRenamed("tree", "of"), F.col("tree").eqNullSafe(F.col("of"))).select(
            "tree", "idx", "top", "steps")
        if above is not None:
            parents = above.select(F.col("tree").alias("of"), F.col("idx").alias("at"), "top", "steps")
            inner = own.where("NOT is_root").join(parents, F.col("tree").eqNullSafe(F.col("of")) & (F.shiftright("idx", 1) == F.col("at")))
            found = found.unionByName(inner.select(
                "tree", "idx", "top", F.concat(F.array(step(F.col("idx"), F.col("sibling"))), "steps").alias("steps")))
        above = stored(found, f"merkle-path-{n}") if n else found
    return above


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf's digest and its steps lead to."""
    return F.aggregate(steps, leaf, lambda d, s: F.when(s["sibling"].isNull(), sha256_of(hex_of(d)))
                       .when(s["left"], sha256_of(hex_of(s["sibling"]), hex_of(d)))
                       .otherwise(sha256_of(hex_of(d), hex_of(s["sibling"]))))


def proof(steps: Column) -> Column:
    """Hex sha256 of the siblings, from the leaf to the root, as hex texts one after the other."""
    present = F.filter(steps, lambda s: s["sibling"].isNotNull())
    return F.sha2(F.array_join(F.transform(present, lambda s: hex_of(s["sibling"])), "").cast("binary"), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot (of the row's lang), root, proof_sha256, folded_root, verified of every row; digests in hex.

    Leaves stand by doc_id in their lang, null first, equal doc_ids by their digest; repeated rows are leaves each. Null is a lang of its
    own, before the others and apart from the empty one. A null in any field is hashed as `-`. A single row is its own root with an empty
    proof. An empty table gives an empty one. Columns beyond the five hashed ones are not read.
    """
    rows = numbered(leaves(docs), "lang", [F.col("doc_id").asc_nulls_first(), F.col("leaf")])
    rows = stored(rows.withColumnRenamed("lang", "tree"), "merkle-leaves")
    levels = sibling_levels(rows.select("tree", "idx", "size", F.col("leaf").alias("digest")))
    subroots = reduce(DataFrame.unionByName, (level.where("size = 1").select("tree", "digest") for level in levels))
    placed = stored(numbered(subroots, None, [F.col("tree").asc_nulls_first()]), "merkle-subroots")
    top = sibling_levels(placed.select(F.lit(0).alias("tree"), "idx", "size", "digest"))
    # The root is one row of the last level; above it there are no steps.
    none = F.array().cast("array<struct<left:boolean,sibling:binary>>")
    root = top[-1].select("tree", F.col("digest").alias("top"), none.alias("steps"))
    over = paths(top, root).select("idx", F.col("top").alias("root"), "steps")
    ends = placed.join(over, "idx").select("tree", F.struct(F.col("digest").alias("subroot"), "root").alias("top"), "steps")
    found = paths(levels, stored(ends, "merkle-tops")).withColumnsRenamed({"tree": "of", "idx": "at"})
    met = rows.join(found, rows["tree"].eqNullSafe(found["of"]) & (rows["idx"] == found["at"]))
    done = met.select("doc_id", "leaf", "top.subroot", "top.root", proof(F.col("steps")).alias("proof_sha256"),
                      folded(F.coalesce("tampered", "leaf"), F.col("steps")).alias("folded_root"))
    return done.select("doc_id", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"),
                       hex_of(F.col("root")).alias("root"), "proof_sha256", hex_of(F.col("folded_root")).alias("folded_root"),
                       (F.col("folded_root") == F.col("root")).alias("verified"))
