"""A corpus pipeline: toxicity, near-dedup, substring dedup, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as
Parquet in the shared folder and gives it, reread, to the next.  All stages but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.llm.packing import pack_documents
from cataloom.llm.recompression import without_repeats
from cataloom.llm.scratch import Scratch
from cataloom.llm.secrets import redact_secrets
from cataloom.llm.simhash import keep_one_of_near_duplicates
from cataloom.llm.toxicity import drop_toxic


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, learnt from ``labels`` outside the held-out fold, rejects."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: five words, a similarity of 0.8 or more."""
    return keep_one_of_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 35 words and more that occur elsewhere out of the texts; keeps all rows."""
    return _counted(without_repeats(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; keeps all rows."""
    return _counted(redact_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 2048 tokens, one row per piece."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Learnt weights, near-duplicate links and tokenizers have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from ``documents`` through all stages."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
