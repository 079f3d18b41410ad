"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), reads all rows that the stage before it kept and returns a
DataFrame; ``run`` writes each result as Parquet below the shared folder and reads it back for the next.
All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from splitsight.llm import decontaminate, exact, jaccard, packing, toxicity
from splitsight.session import scratch_path

VOCABULARY = "word_bpe_49k.json"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least id stays."""
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; shorter hits are cut out of the others."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and offset."""
    return packing.packed(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_exact_copies),
    ("ngram_jaccard", without_near_copies),
    ("decontamination", decontaminated),
    ("best_fit_packing", packed),
]

# Trained models and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
