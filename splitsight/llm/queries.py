"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitsight.llm import bloom_lm, chunks, decontaminate, exact, importance, jaccard, licenses, lines, merkle, packing, personal, toxicity, vectors

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.exact_groups(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def line_dedup(spark: SparkSession, folder: str, min_words: int | None = None) -> DataFrame:
    found = lines.repeated_lines(table(spark, folder, "documents"), min_words=min_words)
    return found.select(
        "doc_id",
        "n_lines",
        F.size("deleted").cast("long").alias("n_deleted"),
        F.array_join("deleted", ",").alias("deleted_lines"),
    )


def line_dedup_words(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(spark, folder, lines.MIN_WORDS)


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.personal_spans(table(spark, folder, "documents"))
    counts = [personal.n_of(k).alias(f"n_{k}") for k in personal.KINDS]
    return found.select("doc_id", *counts, F.sha2(personal.spans_text("base"), 256).alias("base_sha256"), personal.spans_text("spans").alias("spans"))


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_spans(table(spark, folder, "documents"), licenses.templates(spark))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct("licenses.name")), ",").alias("licenses"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["name"], x["first"], x["end"])), ",").alias("places"),
    )


def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.chain_scores(docs, toxicity.train_chain(docs, table(spark, folder, "labels")))
    return scored.select("row.doc_id", F.round("p_quality", 6).alias("p_quality"), F.round("p_toxic", 6).alias("p_toxic"), (F.col("p_toxic") >= 0.5).alias("toxic"))


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = chunks.repeat_spans(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_chunks",
        "n_repeated",
        F.col("n_words").alias("words_removed"),
        removed.alias("chars_removed"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("spans"),
        (F.size("spans") > 0).alias("has_repeats"),
    )


def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_lm.corpus_scores(table(spark, folder, "documents"))


def importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"), kind=importance.Features(1, 1))


def embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.vector_components(table(spark, folder, "embeddings"))


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents; of one in seven a changed n_chars is checked against them."""
    # Wide enough for the largest number and one more.
    changed = merkle.leaf(n_chars=F.col("n_chars").cast("decimal(38,0)") + 1)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.manifest(table(spark, folder, "documents"), checked=F.when(tampered, changed).otherwise(merkle.leaf()))
    found = found.withColumn("folded_root", merkle.folded("checked"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": decontamination,
        "op2_exact_dedup": exact_dedup,
        "op3_line_dedup": line_dedup,
        "op3_line_dedup_words": line_dedup_words,
        "op4_personal_data": personal_data,
        "op5_license_scan": license_scan,
        "op6_best_fit_packing": best_fit_packing,
        "op7_toxicity": toxicity_chain,
        "op8_substring_dedup": substring_dedup,
        "op9_ngram_jaccard": ngram_jaccard,
        "op10_lm_scoring": lm_scoring,
        "op11_embedding_dedup": embedding_dedup,
        "op12_importance_resampling": importance_resampling,
        "op13_merkle_manifest": merkle_manifest,
    }
