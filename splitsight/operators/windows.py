"""Trailing windows that end at an anchor, closed on both ends, and rolling 24 h activity."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from splitsight.functions import hours, micros, to_ntz
from splitsight.operators.behaviour import behaviour_features
from splitsight.operators.clean import debits
from splitsight.operators.hotkeys import DEFAULT_HEAT, HeatLimit, split_by_heat
from splitsight.schema import ANCHOR_FEATURES, SLIDING_FEATURES

TS = "transaction_date"
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_MINUTE = 60_000_000


def resolve_end(tx: DataFrame, end_ts: str | datetime | None = None) -> str | datetime | None:
    """The given end, or the latest timestamp of the table (None if it is empty).

    A known end makes the window bounds literals, which reach the Parquet scan.
    """
    return end_ts if end_ts is not None else tx.agg(F.max(TS)).first()[0]


def window_end(tx: DataFrame, end_ts: str | datetime | None = None) -> Column:
    end = resolve_end(tx, end_ts)
    return F.lit(None).cast("timestamp_ntz") if end is None else to_ntz(end)


def trailing_window(tx: DataFrame, end_ts: str | datetime | None = None, window_hours: float = 24) -> DataFrame:
    """Rows in ``[end - window, end]``."""
    end = window_end(tx, end_ts)
    return tx.where((F.col(TS) >= end - hours(window_hours)) & (F.col(TS) <= end))


def sliding_features(
    tx: DataFrame,
    end_ts: str | datetime | None = None,
    window_hours: float = 24,
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """Debit features per user over the trailing window."""
    rows = debits(trailing_window(tx, end_ts, window_hours))
    return behaviour_features(rows, ["user_id"], SLIDING_FEATURES, limit)


def history(tx: DataFrame, end_ts: str | datetime | None = None, lookback_days: int = 30) -> DataFrame:
    """Debits in ``[end - lookback, end)``."""
    end = window_end(tx, end_ts)
    return debits(tx).where((F.col(TS) >= end - hours(lookback_days * 24)) & (F.col(TS) < end))


def with_anchors(
    rows: DataFrame,
    start: Column,
    lookback_days: int,
    step_hours: float,
    window_hours: float = 24,
    first_anchor: int = 0,
) -> DataFrame:
    """Adds ``analysis_date`` for each anchor ``start + i * step`` whose window holds the row.

    The anchors of a row follow from its timestamp by integer arithmetic on microseconds, so there
    is no join with an anchor table. A row is copied ``window / step`` + 1 times at most, and never
    when the window is shorter than the step.
    """
    step = int(step_hours * MICROS_PER_HOUR)
    window = int(window_hours * MICROS_PER_HOUR)
    last_anchor = int(lookback_days * 24 / step_hours)
    rows = rows.withColumn("_us", micros(TS) - micros(start))
    rows = rows.withColumn(
        "_i", F.greatest(F.expr(f"(_us + {step - 1}) div {step}"), F.lit(first_anchor).cast("long"))
    ).withColumn(
        "_last", F.least(F.expr(f"(_us + {window}) div {step}"), F.lit(last_anchor).cast("long"))
    ).where("_i <= _last")
    if window >= step:
        rows = rows.withColumn("_i", F.explode(F.sequence("_i", "_last")))
    seconds = F.col("_i") * F.lit(step_hours * 3600.0)
    anchor = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return rows.withColumn("analysis_date", anchor).drop("_us", "_i", "_last")


def anchor_features(
    tx: DataFrame,
    end_ts: str | datetime | None = None,
    lookback_days: int = 30,
    step_days: float = 3,
    window_hours: float = 24,
    exclude_current: bool = False,
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """Baseline features per user and anchor.

    The last anchor is the end itself, so the window under test is part of its own history;
    ``exclude_current`` leaves that anchor out.
    """
    end_ts = resolve_end(tx, end_ts)
    end = window_end(tx, end_ts)
    start = end - hours(lookback_days * 24)
    rows = with_anchors(history(tx, end_ts, lookback_days), start, lookback_days, step_days * 24, window_hours)
    if exclude_current:
        rows = rows.where(F.col("analysis_date") < end)
    return behaviour_features(rows, ["user_id", "analysis_date"], ANCHOR_FEATURES, limit)


def daily_sliding_features(
    tx: DataFrame,
    end_ts: str | datetime | None = None,
    lookback_days: int = 30,
    window_hours: float = 24,
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """The full sliding block at every day of the history, from one day after its start."""
    end_ts = resolve_end(tx, end_ts)
    end = window_end(tx, end_ts)
    start = end - hours(lookback_days * 24)
    rows = with_anchors(
        history(tx, end_ts, lookback_days), start, lookback_days, 24, window_hours, first_anchor=1
    )
    return behaviour_features(rows, ["user_id", "analysis_date"], SLIDING_FEATURES, limit)


def top_merchant(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent merchant of each group, the smallest one on ties."""
    counted = (
        rows.where(F.col("merchant_id").isNotNull())
        .groupBy(*keys, "merchant_id")
        .agg(F.count(F.lit(1)).alias("tx_count"))
    )
    # The rank filter is applied before the exchange too, so a group with very many merchants
    # sends one row per map partition.
    best = W.partitionBy(*keys).orderBy(F.desc("tx_count"), F.asc("merchant_id"))
    return (
        counted.withColumn("_rank", F.row_number().over(best))
        .where("_rank = 1")
        .select(*keys, F.col("merchant_id").alias("top_merchant"), "tx_count")
    )


# Rows of a user up to which each window is added up from its rows.
ROLLING_HEAT = HeatLimit(1000)


def rolling_activity(tx: DataFrame, window_hours: float = 24, limit: HeatLimit = ROLLING_HEAT) -> DataFrame:
    """One row per debit at ``t``: the user's debits, amount and merchants in ``[t - window, t]``.

    Sums add the amounts inside the window only, so an earlier large amount leaves no trace. The window has to
    be a whole number of minutes. A sliding frame is computed afresh for each row, so only users with few rows get
    one; the work for a row of any other doesn't grow with the rows of its window.
    """
    span = round(window_hours * MICROS_PER_HOUR)
    if span <= 0 or span % MICROS_PER_MINUTE:
        raise ValueError("the window has to be a whole number of minutes")
    rows = debits(tx).where(F.col("user_id").isNotNull() & F.col(TS).isNotNull())
    rows = rows.select("_id", "user_id", TS, "transaction_amount", "merchant_id", micros(TS).alias("_us"))
    cold, hot = split_by_heat(rows, ["user_id"], limit)
    found = _cold_rolling(cold, span)
    return found if hot is None else found.unionByName(_hot_rolling(hot, span))


def _cold_rolling(rows: DataFrame, span: int) -> DataFrame:
    frame = W.partitionBy("user_id").orderBy("_us").rangeBetween(-span, 0)
    return rows.select(
        "_id",
        "user_id",
        TS,
        F.count("transaction_amount").over(frame).alias("cnt_24h"),
        F.coalesce(F.sum("transaction_amount").over(frame), F.lit(0.0)).alias("sum_24h"),
        F.size(F.collect_set("merchant_id").over(frame)).cast("long").alias("unique_merchants"),
    )


def _minute(us: str | Column) -> Column:
    return F.floor((F.col(us) if isinstance(us, str) else us) / MICROS_PER_MINUTE)


def _hot_rolling(rows: DataFrame, span: int) -> DataFrame:
    """The same from whole minutes and parts of minutes, so that no task holds a user.

    A window is the rest of its first minute, the whole minutes between, and its last minute so far. Groups are the
    rows of a minute (distinct instants only) and the minutes of a user, which the calendar bounds.
    """
    width = span // MICROS_PER_MINUTE
    instants = rows.groupBy("user_id", "_us").agg(
        F.count("transaction_amount").alias("_c"), F.coalesce(F.sum("transaction_amount"), F.lit(0.0)).alias("_s")
    )
    instants = instants.withColumn("_m", _minute("_us"))
    minutes = instants.groupBy("user_id", "_m").agg(F.sum("_c").alias("_c"), F.sum("_s").alias("_s"))
    between = W.partitionBy("user_id").orderBy("_m").rangeBetween(-(width - 1), -1)
    minutes = minutes.select("user_id", "_m", *[F.coalesce(F.sum(x).over(between), F.lit(0)).alias(f"{x}1") for x in ("_c", "_s")])
    so_far = W.partitionBy("user_id", "_m").orderBy("_us").rangeBetween(W.unboundedPreceding, 0)
    last = instants.select("user_id", "_us", "_m", *[F.sum(x).over(so_far).alias(f"{x}2") for x in ("_c", "_s")])
    # Where windows begin, among the instants of that minute, latest first.
    begins = instants.select("user_id", (F.col("_us") - span).alias("_at"), (F.col("_m") - width).alias("_m"), F.col("_us").alias("_for"), F.lit(0).alias("_c"), F.lit(0.0).alias("_s"))
    marks = begins.unionByName(instants.select("user_id", F.col("_us").alias("_at"), "_m", F.lit(None).cast("long").alias("_for"), "_c", "_s"))
    from_here = W.partitionBy("user_id", "_m").orderBy(F.desc("_at")).rangeBetween(W.unboundedPreceding, 0)
    first = marks.select("user_id", F.col("_for").alias("_us"), *[F.sum(x).over(from_here).alias(f"{x}0") for x in ("_c", "_s")]).where("_us IS NOT NULL")
    totals = last.join(minutes, ["user_id", "_m"]).join(first, ["user_id", "_us"])
    totals = totals.select("user_id", "_us", (F.col("_c0") + F.col("_c1") + F.col("_c2")).alias("cnt_24h"), (F.col("_s0") + F.col("_s1") + F.col("_s2")).alias("sum_24h"))
    known = totals.join(_hot_merchants(rows, instants, span), ["user_id", "_us"])
    return rows.select("_id", "user_id", TS, "_us").join(known, ["user_id", "_us"]).select("_id", "user_id", TS, "cnt_24h", "sum_24h", "unique_merchants")


def _hot_merchants(rows: DataFrame, instants: DataFrame, span: int) -> DataFrame:
    """Merchants in the window at each instant, from the stretches in which each merchant counts.

    A stretch begins with a row and ends a window after the last row that follows within a window.
    """
    seen = rows.where(F.col("merchant_id").isNotNull()).groupBy("user_id", "merchant_id", _minute("_us").alias("_m"))
    seen = seen.agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    order = W.partitionBy("user_id", "merchant_id").orderBy("_m")
    begins = F.coalesce(F.col("_first") - F.lag("_last").over(order) > span, F.lit(True))
    ends = F.coalesce(F.lead("_first").over(order) - F.col("_last") > span, F.lit(True))
    seen = seen.withColumn("_begins", begins).withColumn("_ends", ends)
    steps = seen.where("_begins").select("user_id", F.col("_first").alias("_us"), F.lit(1).alias("_step"), F.lit(False).alias("_asks"))
    steps = steps.unionByName(seen.where("_ends").select("user_id", (F.col("_last") + span + 1).alias("_us"), F.lit(-1).alias("_step"), F.lit(False).alias("_asks")))
    steps = steps.unionByName(instants.select("user_id", "_us", F.lit(0).alias("_step"), F.lit(True).alias("_asks"))).withColumn("_m", _minute("_us"))
    before = W.partitionBy("user_id").orderBy("_m").rowsBetween(W.unboundedPreceding, -1)
    minutes = steps.groupBy("user_id", "_m").agg(F.sum("_step").alias("_n"))
    minutes = minutes.select("user_id", "_m", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"))
    so_far = W.partitionBy("user_id", "_m").orderBy("_us").rangeBetween(W.unboundedPreceding, 0)
    counted = steps.select("user_id", "_us", "_m", "_asks", F.sum("_step").over(so_far).alias("_n1")).where("_asks")
    return counted.join(minutes, ["user_id", "_m"]).select("user_id", "_us", (F.col("_n0") + F.col("_n1")).alias("unique_merchants"))
