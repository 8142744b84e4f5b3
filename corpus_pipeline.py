"""Corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet to the shared folder and reads it back as the next stage's docs.
The last stage returns the mix, one row per slot; the others return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, jaccard_join, mixing, quality_rules, secret_scan
from tidemark.llm.common import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.reject_outliers(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays (5-word n-grams, Jaccard 0.8)."""
    return jaccard_join.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover 5 % of the words or more go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become a mark; no document goes."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Slots of the mix, with the documents that each block's words come from."""
    return mixing.mix_blocks(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("mixing", mixed),
]

# The stages are not expressible in SQL (robust fits by steps, automata, seeded draws).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
