"""From raw documents to packed training windows: the corpus operators as stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. `run` writes every stage's rows as
Parquet to the shared folder and reads them again, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, minhash, packing, quality, queries, secrets
from shelfmark.llm.common import ready, stored

WINDOW = 1024


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is among `ids` (one column); a null doc_id matches a null."""
    found = ids.select(F.col(ids.columns[0]).alias("__id")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["__id"]), "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return _kept(docs, minhash.near_duplicates(docs).where("kept").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return secrets.redact(docs)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in windows; one row per piece with its token ids."""
    return packing.pack(docs, queries.tokenizer_path(), WINDOW)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", packed_windows),
]

# Learned rules, sketches and tokenizers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
