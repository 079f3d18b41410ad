"""Batch jobs over a range of days: clean, featurise, train, score."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from splitsight.operators import alerts, iforest
from splitsight.operators.behaviour import user_day_features
from splitsight.operators.clean import active_only, between_days, drop_duplicate_ids
from splitsight.operators.hotkeys import DEFAULT_HEAT, HeatLimit
from splitsight.sources import sinks
from splitsight.sources.transactions import read_coerced, read_partitioned

MIN_CNT = 10


def check_range(start: str | date, end: str | date) -> None:
    if str(end) < str(start):
        raise ValueError("the end of the range lies before its start")


def clean_days(spark: SparkSession, raw_path: str, clean_path: str, start: str | date, end: str | date) -> None:
    """Coerced, deduplicated rows of the days, one partition per day, in one job.

    Ids are unique within a day, as in a day-by-day run.
    """
    check_range(start, end)
    rows = between_days(read_coerced(spark, raw_path), start, end)
    sinks.write_clean_days(drop_duplicate_ids(rows, within_day=True), clean_path)


def feature_days(
    spark: SparkSession,
    clean_path: str,
    features_path: str,
    start: str | date,
    end: str | date,
    limit: HeatLimit = DEFAULT_HEAT,
) -> None:
    check_range(start, end)
    rows = read_partitioned(spark, clean_path, start, end)
    sinks.write_feature_days(user_day_features(rows.drop("date"), limit), features_path)


def train(
    spark: SparkSession,
    features_path: str,
    model_path: str,
    start: str | date,
    end: str | date,
    min_cnt: int = MIN_CNT,
    **settings,
) -> iforest.ForestModel:
    """Fits on the active user-days of the range and stores the model tables."""
    active = active_only(read_partitioned(spark, features_path, start, end), min_cnt)
    model = iforest.fit(active, **settings)
    iforest.save(spark, model, model_path)
    return model


def backfill(
    spark: SparkSession,
    raw_path: str,
    clean_path: str,
    features_path: str,
    model_path: str,
    start: str | date,
    end: str | date,
    min_cnt: int = MIN_CNT,
    **settings,
) -> iforest.ForestModel:
    """All days of the range from raw table to trained model."""
    clean_days(spark, raw_path, clean_path, start, end)
    feature_days(spark, clean_path, features_path, start, end)
    return train(spark, features_path, model_path, start, end, min_cnt, **settings)


def score_days(
    spark: SparkSession,
    features_path: str,
    model_path: str,
    start: str | date,
    end: str | date | None = None,
    min_cnt: int = MIN_CNT,
    alerts_path: str | None = None,
    flagged_only: bool = False,
) -> DataFrame:
    """Alert table of one day or a range; written as CSV if a path is given."""
    end = start if end is None else end
    check_range(start, end)
    model = iforest.load(spark, model_path)
    active = active_only(read_partitioned(spark, features_path, start, end), min_cnt)
    scored = alerts.alert_table(active, model)
    if alerts_path is not None:
        sinks.write_alerts_csv(scored, alerts_path, flagged_only)
    return scored
