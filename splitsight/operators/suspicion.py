"""Weighted z-score of a user's window against the baseline, risk levels and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.functions import bands
from splitsight.schema import BASELINE_METRICS

# Weight of each metric, alert threshold, band edges and labels.
WEIGHTS = {
    "cnt_24h": 3.5,
    "sum_24h": 1.0,
    "avg_interval_minutes": 1.5,
    "same_amount_ratio": 1.0,
    "merchant_concentration": 1.0,
    "amount_cv": -0.3,
    "unique_merchants": -0.3,
    "hour_dispersion": -0.3,
}
ALERT_THRESHOLD = 4.0
LOW_COUNT = 3
RISK_BANDS = [(1.0, "Bajo"), (2.5, "Medio"), (4.0, "Alto")]
RISK_ABOVE = "Crítico"
PRIORITY_BANDS = [(5.0, "Media"), (8.0, "Alta")]
PRIORITY_ABOVE = "Crítica"
PRIORITY_FLOOR = 3.0
SUMMARY_COLUMNS = [
    "user_id",
    "suspicion_score",
    "risk_level",
    "cnt_24h",
    "sum_24h",
    "avg_interval_minutes",
    "same_amount_ratio",
    "unique_merchants",
]


def z_scores(with_base: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Adds ``z_<m>``; a zero deviation counts as 1, metrics without baseline keep their value."""
    added = {}
    for m in weights:
        z = f"({m} - {m}_mean) / CASE WHEN {m}_std = 0 THEN 1 ELSE {m}_std END" if m in BASELINE_METRICS else m
        added[f"z_{m}"] = F.expr(f"CAST({z} AS DOUBLE)")
    helpers = [f"{m}_{part}" for m in BASELINE_METRICS for part in ("mean", "std")]
    return with_base.withColumns(added).drop(*helpers)


def suspicion_scores(z: DataFrame, weights: dict[str, float] = WEIGHTS, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Adds ``suspicion_score``, ``risk_level`` and ``flag_suspicious``.

    Short gaps count fully and long gaps half, both as positive amounts. Users with few
    transactions get half the score. A NULL score has no level and no flag.
    """
    score = F.lit(0.0)
    for metric, weight in weights.items():
        column = F.col(f"z_{metric}")
        if metric == "avg_interval_minutes":
            score = score + F.lit(weight) * F.abs(column) * F.when(column < 0, 1.0).otherwise(0.5)
        else:
            score = score + F.lit(weight) * column
    halved = score * F.when(F.col("cnt_24h") <= LOW_COUNT, 0.5).otherwise(1.0)
    return (
        z.withColumn("suspicion_score", halved)
        .withColumn("risk_level", bands(F.col("suspicion_score"), RISK_BANDS, RISK_ABOVE))
        .withColumn("flag_suspicious", F.coalesce(F.col("suspicion_score") >= threshold, F.lit(False)))
    )


def alerts(scores: DataFrame) -> DataFrame:
    """Flagged users, most suspicious first, with ``investigation_priority``."""
    score = F.col("suspicion_score")
    priority = F.when(score > PRIORITY_FLOOR, bands(score, PRIORITY_BANDS, PRIORITY_ABOVE))
    return (
        scores.where("flag_suspicious")
        .withColumn("investigation_priority", priority)
        .orderBy(F.desc("suspicion_score"), "user_id")
    )


def top_alerts(scores: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most suspicious alerts as a short summary."""
    return (
        scores.where("flag_suspicious")
        .orderBy(F.desc("suspicion_score"), "user_id")
        .limit(n)
        .select(*SUMMARY_COLUMNS)
    )


def risk_distribution(scores: DataFrame) -> DataFrame:
    """Users per risk level, most frequent first; users without a level are left out."""
    return (
        scores.where(F.col("risk_level").isNotNull())
        .groupBy("risk_level")
        .agg(F.count(F.lit(1)).alias("users"))
        .orderBy(F.desc("users"), "risk_level")
    )


def detection_rate(scores: DataFrame) -> DataFrame:
    flagged = F.sum(F.col("flag_suspicious").cast("long"))
    total = F.count(F.lit(1))
    return scores.agg(
        total.alias("users"),
        F.coalesce(flagged, F.lit(0)).alias("alerts"),
        F.try_divide(flagged * 100.0, total).alias("detection_pct"),
        F.max("suspicion_score").alias("max_score"),
    )


def z_importance(scores: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Mean absolute z per metric, ascending."""
    means = scores.agg(*[F.avg(F.abs(f"z_{m}")).alias(m) for m in weights])
    return means.unpivot([], list(weights), "metric", "mean_abs_z").orderBy("mean_abs_z", "metric")


def score_scatter(scores: DataFrame) -> DataFrame:
    """Frequency against score, the numbers behind the scatter chart."""
    return scores.select("user_id", "cnt_24h", "suspicion_score")
