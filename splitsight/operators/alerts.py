"""Alert table of the forest: static and per-day dynamic flags, ranking, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.operators.iforest import CONTAMINATION, ForestModel, decision_scores
from splitsight.operators.quantiles import exact_quantiles
from splitsight.session import stored

OPTIONAL_COLUMNS = {
    "cnt_24h": "long",
    "sum_24h": "double",
    "avg_amount": "double",
    "unique_merchants": "long",
}
ALERT_COLUMNS = [
    "user_id",
    "date",
    *OPTIONAL_COLUMNS,
    "anomaly_score",
    "flag_suspicious",
    "flag_suspicious_dynamic",
]


def day_thresholds(decisions: DataFrame, contamination: float) -> DataFrame:
    """Per day the score at the expected share of anomalies, linearly interpolated."""
    return exact_quantiles(decisions, "anomaly_score", {"threshold": contamination}, by=["date"])


def with_dynamic_flag(decisions: DataFrame, contamination: float | None) -> DataFrame:
    """Flags scores strictly below the threshold of their own day."""
    share = CONTAMINATION if contamination is None else contamination
    return decisions.join(day_thresholds(decisions, share), "date").withColumn(
        "flag_suspicious_dynamic", F.col("anomaly_score") < F.col("threshold")
    )


def scored_rows(features: DataFrame, model: ForestModel) -> DataFrame:
    """Scores and static flags; feature columns that are missing come out NULL."""
    return _without_dynamic(decision_scores(features, model))


def _without_dynamic(decisions: DataFrame) -> DataFrame:
    missing = {c: F.lit(None).cast(kind) for c, kind in OPTIONAL_COLUMNS.items() if c not in decisions.columns}
    return decisions.withColumns(missing).select("user_id", "date", *OPTIONAL_COLUMNS, "anomaly_score", "flag_suspicious")


def flagged(decisions: DataFrame, contamination: float | None) -> DataFrame:
    """The alert table of rows that are scored and stored."""
    return with_dynamic_flag(_without_dynamic(decisions), contamination).select(*ALERT_COLUMNS)


def alert_table(features: DataFrame, model: ForestModel) -> DataFrame:
    """All scored user-days in nine columns.

    The scored rows are stored once, since the threshold of a day and the flag both need them.
    """
    return flagged(stored(scored_rows(features, model), "decisions"), model.contamination)


def lowest_scores(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.orderBy("anomaly_score", "user_id", "date").limit(n)


def flag_totals(scored: DataFrame) -> DataFrame:
    """Scored rows and rows with each flag: one row."""
    return scored.agg(
        F.count(F.lit(1)).alias("scored"),
        F.coalesce(F.sum(F.col("flag_suspicious").cast("long")), F.lit(0)).alias("static_flags"),
        F.coalesce(F.sum(F.col("flag_suspicious_dynamic").cast("long")), F.lit(0)).alias("dynamic_flags"),
    )
