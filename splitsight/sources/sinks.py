"""Writing clean days, feature days, snapshots and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.operators.clean import with_partition_columns

DAY_PARTITIONS = ["year", "month", "day"]
BATCH = "batch"


def _replace_days(df: DataFrame, path: str, date_column: str) -> None:
    """Writes every day of ``df`` in one job and replaces just those days.

    The rebalance groups rows by day; AQE then splits busy days over several tasks and merges quiet
    ones, so files are neither tiny nor written by one task per day.
    """
    rows = with_partition_columns(df, F.col(date_column)).where(F.col("year").isNotNull())
    (
        rows.hint("rebalance", *[F.col(c) for c in DAY_PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_PARTITIONS)
        .parquet(path)
    )


def write_batch(df: DataFrame, path: str, date_column: str, number: int) -> None:
    """Writes numbered batches side by side in every day; a repeated batch replaces its own rows only."""
    rows = with_partition_columns(df, F.col(date_column)).withColumn(BATCH, F.lit(number))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_PARTITIONS, BATCH)
        .parquet(path)
    )


def write_clean_days(tx: DataFrame, path: str) -> None:
    _replace_days(tx, path, "transaction_date")


def write_feature_days(features: DataFrame, path: str) -> None:
    _replace_days(features, path, "date")


def write_snapshot(tx: DataFrame, path: str) -> None:
    """The whole table as one Parquet snapshot."""
    tx.write.mode("overwrite").parquet(path)


def write_alerts_csv(scored: DataFrame, path: str, flagged_only: bool = False) -> None:
    """All scored rows as headered CSV parts; ``flagged_only`` keeps rows with either flag."""
    rows = scored.where("flag_suspicious or flag_suspicious_dynamic") if flagged_only else scored
    rows.write.mode("overwrite").option("header", True).csv(path)
