"""Behaviour features of debit groups: user-day, trailing window or historical anchor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitsight.functions import ratio_or_zero
from splitsight.operators import grouped
from splitsight.operators.clean import debits
from splitsight.operators.hotkeys import DEFAULT_HEAT, HeatLimit, dealt_by_heat
from splitsight.schema import MODEL_FEATURES

AMOUNT = "transaction_amount"
TS = "transaction_date"

# Counted column -> name of the share of its most frequent value.
SHARES = {
    "merchant_id": "merchant_concentration",
    "subsidiary": "subsidiary_concentration",
    AMOUNT: "same_amount_ratio",
}
DISTINCTS = {"merchant_id": "unique_merchants", "subsidiary": "unique_subsidiaries"}


def _base_aggregates() -> list[Column]:
    """Aggregates that combine on the map side whatever the group size."""
    hour_bit = F.expr(f"shiftleft(1, hour({TS}))")
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.count(AMOUNT).alias("cnt_24h"),
        F.coalesce(F.sum(AMOUNT), F.lit(0.0)).alias("sum_24h"),
        F.avg(AMOUNT).alias("avg_amount"),
        F.coalesce(F.stddev_samp(AMOUNT), F.lit(0.0)).alias("amount_std"),
        (F.max(AMOUNT) - F.min(AMOUNT)).alias("amount_range"),
        F.coalesce(F.bit_count(F.bit_or(hour_bit)), F.lit(0)).cast("long").alias("hour_dispersion"),
    ]


def behaviour_features(
    tx: DataFrame,
    keys: list[str],
    columns: list[str],
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """``keys`` plus the feature ``columns`` for each group of ``tx``.

    Rows with a NULL key belong to no group. ``avg_amount`` stays NULL in a group without amounts.
    """
    counted = [
        c for c in SHARES if SHARES[c] in columns or DISTINCTS.get(c) in columns
    ]
    used = list(dict.fromkeys([*keys, TS, AMOUNT, *counted]))
    rows = tx.select(*used).dropna(subset=keys)
    cold, hot = dealt_by_heat(rows, keys, limit)
    features = _cold_features(cold, keys, counted)
    if hot is not None:
        features = features.unionByName(_hot_features(hot, keys, counted))
    return features.withColumn(
        "amount_cv", ratio_or_zero(F.col("amount_std"), F.col("avg_amount"))
    ).select(*keys, *columns)


def _cold_features(cold: DataFrame, keys: list[str], counted: list[str]) -> DataFrame:
    rows = grouped.with_gaps(grouped.with_value_tallies(cold, keys, counted), keys)
    return rows.groupBy(*keys).agg(
        *_base_aggregates(),
        *[grouped.distinct_values(c).alias(DISTINCTS[c]) for c in counted if c in DISTINCTS],
        *[grouped.top_share(c).alias(SHARES[c]) for c in counted],
        F.coalesce(F.avg("_gap"), F.lit(0.0)).alias("avg_interval_minutes"),
        F.coalesce(F.stddev_samp("_gap"), F.lit(0.0)).alias("std_interval_minutes"),
    )


def _hot_features(hot: DataFrame, keys: list[str], counted: list[str]) -> DataFrame:
    base = hot.groupBy(*keys).agg(*_base_aggregates())
    parts = [grouped.hot_value_stats(hot, keys, c) for c in counted]
    parts.append(grouped.hot_gap_stats(grouped.hot_gaps(hot, keys), keys))
    joined = grouped.join_stats(base, parts, keys)
    for c in counted:
        joined = joined.withColumn(SHARES[c], F.col(f"_top_{c}") / F.col("_rows"))
        if c in DISTINCTS:
            joined = joined.withColumn(DISTINCTS[c], F.coalesce(f"_distinct_{c}", F.lit(0)))
    kept = [c for c in joined.columns if not c.startswith("_")]
    return joined.select(
        *kept,
        "_rows",
        F.coalesce("_gap_avg", F.lit(0.0)).alias("avg_interval_minutes"),
        F.coalesce("_gap_std", F.lit(0.0)).alias("std_interval_minutes"),
    )


def user_day_features(tx: DataFrame, limit: HeatLimit = DEFAULT_HEAT) -> DataFrame:
    """Features of each user's debits on each calendar day, with the date as ``date``.

    ``tx`` is read twice, for the hot-key check and for the features: pass a stored table.
    """
    days = debits(tx).withColumn("date", F.to_date(TS)).where(F.col("date").isNotNull())
    return behaviour_features(days, ["user_id", "date"], MODEL_FEATURES, limit).withColumn(
        "avg_amount", F.coalesce("avg_amount", F.lit(0.0))
    )
