"""The corpus queries by name, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    decontaminate, divergence, hilbert, merkle, minhash, packing, quality, revisits, secrets, substrings, toxicity, urls, wordvectors,
)
from shelfmark.llm.common import ready

SHARDS = 24
WINDOW = 1024
Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(revisits.capture_log(_table(spark, sf_dir, "pages")))
    return found.withColumn("headers", revisits.header_lines(F.col("headers")))


def op2_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_minhash_stars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op4_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), WINDOW, with_ids=False)


def op8_suffix_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op9_shift_and_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.document_shards(_table(spark, sf_dir, "documents"), SHARDS)


def op11_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordvectors.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_revisit_resolution": op1_revisit_resolution,
    "op2_cnn_toxicity": op2_cnn_toxicity,
    "op3_minhash_stars": op3_minhash_stars,
    "op4_trigram_secrets": op4_trigram_secrets,
    "op5_decision_list": op5_decision_list,
    "op6_simhash_windows": op6_simhash_windows,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_suffix_tree_repeats": op8_suffix_tree_repeats,
    "op9_shift_and_urls": op9_shift_and_urls,
    "op10_hilbert_shards": op10_hilbert_shards,
    "op11_random_indexing": op11_random_indexing,
    "op12_source_divergence": op12_source_divergence,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from shelfmark.llm import sql

    return dict(sql.STATEMENTS)
