"""Per-group building blocks in two forms with equal results.

*Cold* groups are below the hot-key limit. One exchange on the group keys serves all windows over
the group and the final aggregation.

*Hot* groups may hold any share of the table. They are handled with aggregations that combine on
the map side and whose shuffle keys include the counted value or a time slice, so that no task sees
a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from splitsight.functions import micros, minutes_between
from splitsight.session import stored

TS = "transaction_date"
MICROS_PER_MINUTE = 60_000_000


# ---------------------------------------------------------------- cold groups


def with_value_tallies(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Adds ``_n_<c>`` (rows sharing the value, 0 for NULL) and ``_new_<c>`` (1 once per value)."""
    added = {}
    for c in columns:
        same = W.partitionBy(*keys, c)
        first = F.row_number().over(same.orderBy(TS)) == 1
        added[f"_new_{c}"] = (F.col(c).isNotNull() & first).cast("long")
        added[f"_n_{c}"] = F.count(c).over(same)
    return df.withColumns(added)


def with_gaps(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_prev`` (previous timestamp in the group) and ``_gap`` (minutes since then)."""
    timeline = W.partitionBy(*keys).orderBy(F.col(TS).asc_nulls_last())
    return df.withColumn("_prev", F.lag(TS).over(timeline)).withColumn(
        "_gap", minutes_between(F.col("_prev"), F.col(TS))
    )


def top_share(column: str) -> Column:
    """Rows of the most frequent value over all rows, NULL when there is no value."""
    return F.nullif(F.max(f"_n_{column}"), F.lit(0)) / F.count(F.lit(1))


def distinct_values(column: str) -> Column:
    return F.sum(f"_new_{column}")


# ---------------------------------------------------------------- hot groups


def hot_value_stats(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Per group: ``_distinct_<c>`` and ``_top_<c>`` (rows of the most frequent value)."""
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys, column)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"_distinct_{column}"), F.max("_n").alias(f"_top_{column}")
    )


def hot_gaps(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every consecutive gap of each group as (keys, ``_gap`` minutes, ``_weight``).

    Rows are first reduced to distinct instants. The gaps inside one minute come from a window over
    that minute (at most 60 million microsecond instants), the gaps between minutes from a window
    over the minutes of the group (bounded by the calendar). Rows at the same instant are zero gaps.
    They are stored, since several statistics read them: an adaptive plan also loses count of the partitions of
    a union that it joins with other branches.
    """
    instants = (
        df.where(F.col(TS).isNotNull()).groupBy(*keys, TS).agg(F.count(F.lit(1)).alias("_same"))
    ).withColumn("_minute", F.floor(micros(TS) / MICROS_PER_MINUTE))

    in_minute = W.partitionBy(*keys, "_minute").orderBy(TS)
    inside = instants.select(
        *keys, minutes_between(F.lag(TS).over(in_minute), F.col(TS)).alias("_gap"), F.lit(1).cast("long").alias("_weight")
    )
    edges = instants.groupBy(*keys, "_minute").agg(F.min(TS).alias("_first"), F.max(TS).alias("_last"))
    over_minutes = W.partitionBy(*keys).orderBy("_minute")
    between = edges.select(
        *keys,
        minutes_between(F.lag("_last").over(over_minutes), F.col("_first")).alias("_gap"),
        F.lit(1).cast("long").alias("_weight"),
    )
    same = instants.where("_same > 1").select(*keys, F.lit(0.0).alias("_gap"), (F.col("_same") - 1).alias("_weight"))
    return stored(inside.unionByName(between).where(F.col("_gap").isNotNull()).unionByName(same), "gaps")


def hot_gap_stats(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """Per group ``_gaps``, ``_gap_avg``, ``_gap_std`` (sample) and ``_bursts`` (gaps under 2 min)."""
    totals = gaps.groupBy(*keys).agg(
        F.sum("_weight").alias("_gaps"),
        (F.sum(F.col("_gap") * F.col("_weight")) / F.sum("_weight")).alias("_gap_avg"),
        F.sum(F.when(F.col("_gap") < 2, F.col("_weight")).otherwise(0)).alias("_bursts"),
    )
    spread = gaps.join(totals, keys).groupBy(*keys).agg(
        F.sum(F.col("_weight") * F.pow(F.col("_gap") - F.col("_gap_avg"), 2)).alias("_sq")
    )
    return totals.join(spread, keys).select(
        *keys,
        "_gaps",
        "_gap_avg",
        F.sqrt(F.try_divide(F.col("_sq"), F.col("_gaps") - 1)).alias("_gap_std"),
        "_bursts",
    )


def join_stats(base: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left joins of per-group tables that all are unique on ``keys``."""
    for part in parts:
        base = base.join(part, keys, "left")
    return base
