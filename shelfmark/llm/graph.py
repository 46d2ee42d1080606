"""Connected components of an edge table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); a component is named by its smallest node.

    Each round every node left points to its smallest neighbour, and the edges move to where their ends point. Ends that
    meet are done, so stars with the smallest node in the middle take one round. Rounds are written to the shared folder.
    A node with any number of neighbours is one row after the partial aggregation; the joins back can be split.
    """
    left = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    points = None
    while True:
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("from")).agg(F.min("b").alias("to")).select("from", F.least("from", "to").alias("to"))
        least = stored(least, "pointers")
        if points is None:
            points = least.select(F.col("from").alias("node"), F.col("to").alias("component"))
        else:
            moved = points.join(least, F.col("component") == F.col("from"), "left")
            points = stored(moved.select("node", F.coalesce("to", "component").alias("component")), "components")
        ends = left.join(least.select(F.col("from").alias("a"), F.col("to").alias("x")), "a").join(
            least.select(F.col("from").alias("b"), F.col("to").alias("y")), "b")
        left = stored(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if left.isEmpty():
            return points
