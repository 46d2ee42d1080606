"""Products bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.ordering import number_rows
from shelfmark.session import durable

BLOCK = 256  # products that one block of an order holds on average


def pair_counts(rev: DataFrame, min_support: int = 3, block: int = BLOCK) -> DataFrame:
    """`product_a < product_b` with the number of orders that hold both, at least `min_support`.

    Only products found in `min_support` orders can be part of an answer, so the others leave first.
    """
    bought = rev.filter(F.col("quantity") > 0).select("order_id", "product_id").distinct()
    frequent = bought.groupBy("product_id").agg(F.count("*").alias("_orders")).filter(F.col("_orders") >= min_support)
    # Written once: both sides of the pairs read these short rows instead of joining items and orders again.
    baskets = durable(bought.join(frequent.select("product_id"), "product_id", "left_semi"))
    counted = order_pairs(baskets, block).groupBy("product_a", "product_b").agg(F.count("*").alias("times_bought_together"))
    return counted.filter(F.col("times_bought_together") >= min_support)


def order_pairs(baskets: DataFrame, block: int = BLOCK) -> DataFrame:
    """All pairs of products of an order, from distinct (order_id, product_id).

    The products of an order are dealt by hash into blocks of about `block`, and block meets block under
    the key (order, low block, high block). The pairs of one very large order are thereby spread over all
    tasks; a usual order is one block. The number of tasks is given, because AQE would merge partitions by
    their few bytes and not by the pairs made of them.
    """
    sizes = baskets.groupBy("order_id").agg(F.ceil(F.count("*") / block).alias("_blocks"))
    dealt = baskets.join(sizes, "order_id").withColumn("_block", F.pmod(F.xxhash64("product_id"), F.col("_blocks")))
    key = ["order_id", "_low", "_high"]
    tasks = int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low = dealt.select("order_id", F.col("_block").alias("_low"), F.col("product_id").alias("_p"),
                       F.explode(F.sequence("_block", F.col("_blocks") - 1)).alias("_high"))
    high = dealt.select("order_id", F.col("_block").alias("_high"), F.col("product_id").alias("_q"),
                        F.explode(F.sequence(F.lit(0).cast("bigint"), "_block")).alias("_low"))
    met = low.repartition(tasks, *key).join(high.repartition(tasks, *key), key)
    pairs = met.filter((F.col("_low") < F.col("_high")) | (F.col("_p") < F.col("_q")))
    return pairs.select("order_id", F.least("_p", "_q").alias("product_a"), F.greatest("_p", "_q").alias("product_b"))


def basket_pairs(rev: DataFrame, min_support: int = 3, block: int = BLOCK) -> DataFrame:
    """Product pairs ranked by how often they were bought together. No two pairs share a sort key,
    so DENSE_RANK is the row number."""
    counted = pair_counts(rev, min_support, block)
    order = [F.col("times_bought_together").desc(), F.col("product_a").asc(), F.col("product_b").asc()]
    return number_rows(counted, order).select(
        "product_a", "product_b", "times_bought_together", F.col("row_number").alias("pair_rank"))
