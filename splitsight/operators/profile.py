"""Profile and rule score of persistently active users, over all their transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from splitsight.functions import ratio_or_zero
from splitsight.operators import grouped
from splitsight.operators.hotkeys import DEFAULT_HEAT, HeatLimit, dealt_by_heat
from splitsight.operators.quantiles import exact_quantiles

AMOUNT = "transaction_amount"
TS = "transaction_date"
KEY = ["user_id"]
COUNTED = ["merchant_id", "subsidiary"]

# Size guard, histogram size, burst gap and rule thresholds.
MIN_ROWS = 5
MAX_BINS = 20
LOW_CV = 0.2
HOUR_SHARE = 0.3
BURST_SHARE = 0.3
ROUND_SHARE = 0.5
BIN_SHARE = 0.4
SINGLE_MERCHANT_ROWS = 20
CRITICAL_SCORE = 0.5

PROFILE_COLUMNS = [
    "user_id",
    "total_trans",
    "dias_activos",
    "cv_monto",
    "concentracion_horaria",
    "cv_intervalos",
    "mediana_intervalo_min",
    "pct_rafagas",
    "pct_montos_exactos",
    "pct_montos_terminan_5",
    "concentracion_montos",
    "comercios_unicos",
    "concentracion_comercio",
    "sucursales_unicas",
    "concentracion_sucursal",
    "score_fraccionamiento",
    "monto_promedio",
    "monto_total",
]


def structuring_profile(
    tx: DataFrame,
    users: DataFrame,
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """One row per user of ``users`` with at least five transactions.

    Hot users are looked for in the whole table, which saves that check the join with ``users``.
    ``tx`` is read more than once: pass a stored table.
    """
    sizes = tx.select(*KEY).dropna()
    cold, hot = dealt_by_heat(tx.select(*KEY, TS, AMOUNT, *COUNTED), KEY, limit, sizes, among=users)
    profile = _cold_profile(cold)
    if hot is not None:
        profile = profile.unionByName(_hot_profile(hot))
    return profile.withColumn("score_fraccionamiento", rule_score()).select(*PROFILE_COLUMNS)


def rule_score() -> Column:
    """Sum of the weights of the rules that hit, at most 1."""
    rules = [
        (F.col("cv_monto") < LOW_CV, 0.25),
        (F.col("concentracion_horaria") > HOUR_SHARE, 0.20),
        (F.col("pct_rafagas") > BURST_SHARE, 0.20),
        (F.col("pct_montos_exactos") > ROUND_SHARE, 0.15),
        ((F.col("comercios_unicos") == 1) & (F.col("total_trans") > SINGLE_MERCHANT_ROWS), 0.10),
        (F.col("concentracion_montos") > BIN_SHARE, 0.10),
    ]
    score = F.lit(0.0)
    for hit, weight in rules:
        score = score + F.when(hit, weight).otherwise(0.0)
    return F.round(F.least(score, F.lit(1.0)), 2)


def _share_of(hit: Column) -> Column:
    return F.count(F.when(hit, 1)) / F.count(F.lit(1))


def _base_aggregates() -> list[Column]:
    """The parts that combine on the map side whatever the group size."""
    per_hour = [F.expr(f"count_if(hour({TS}) = {h})") for h in range(24)]
    amount = F.col(AMOUNT)
    return [
        F.count(F.lit(1)).alias("total_trans"),
        F.when(F.avg(amount) > 0, F.stddev_samp(amount) / F.avg(amount)).otherwise(0.0).alias("cv_monto"),
        (F.greatest(*per_hour) / F.count(F.lit(1))).alias("concentracion_horaria"),
        _share_of(amount % 10 == 0).alias("pct_montos_exactos"),
        _share_of((amount % 5 == 0) & (amount % 10 != 0)).alias("pct_montos_terminan_5"),
        F.avg(amount).alias("monto_promedio"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("monto_total"),
    ]


def _amount_bin(rows: Column, low: Column, high: Column) -> Column:
    """Bin of an amount among ``min(20, rows / 2)`` equal-width bins of its user."""
    bins = F.least(F.lit(MAX_BINS), F.floor(rows / 2))
    width = (high - low) / bins
    amount = F.col(AMOUNT)
    guess = F.least(F.floor((amount - low) / (high - low) * bins), bins - 1)
    exact = (
        guess
        - (amount < low + guess * width).cast("long")
        + ((amount >= low + (guess + 1) * width) & (guess < bins - 1)).cast("long")
    )
    return F.when(high == low, F.when(amount.isNotNull(), F.lit(0).cast("long"))).otherwise(exact)


def _cold_profile(cold: DataFrame) -> DataFrame:
    whole = W.partitionBy(*KEY)
    rows = grouped.with_gaps(grouped.with_value_tallies(cold, KEY, COUNTED), KEY)
    rows = rows.withColumns(
        {
            "_bin": _amount_bin(
                F.count(F.lit(1)).over(whole), F.min(AMOUNT).over(whole), F.max(AMOUNT).over(whole)
            ),
            "_new_day": F.col(TS).isNotNull()
            & (F.col("_prev").isNull() | (F.to_date("_prev") != F.to_date(TS))),
            "_place": F.row_number().over(whole.orderBy(F.col("_gap").asc_nulls_last())),
            "_gaps": F.count("_gap").over(whole),
        }
    )
    # The one or two gaps in the middle; unlike a percentile buffer, the sort can spill.
    middle = (2 * F.col("_place")).between(F.col("_gaps"), F.col("_gaps") + 2)
    per_bin = [F.expr(f"count_if(_bin = {b})") for b in range(MAX_BINS)]
    rows_in_group = F.count(F.lit(1))
    gap_avg = F.avg("_gap")
    return (
        rows.groupBy(*KEY)
        .agg(
            *_base_aggregates(),
            F.count(F.when(F.col("_new_day"), 1)).alias("dias_activos"),
            F.when(gap_avg > 0, F.stddev_samp("_gap") / gap_avg).otherwise(0.0).alias("cv_intervalos"),
            F.coalesce(F.avg(F.when(middle, F.col("_gap"))), F.lit(0.0)).alias("mediana_intervalo_min"),
            ratio_or_zero(F.count(F.when(F.col("_gap") < 2, 1)), F.count("_gap")).alias("pct_rafagas"),
            (F.greatest(*per_bin) / rows_in_group).alias("concentracion_montos"),
            grouped.distinct_values("merchant_id").alias("comercios_unicos"),
            grouped.top_share("merchant_id").alias("concentracion_comercio"),
            grouped.distinct_values("subsidiary").alias("sucursales_unicas"),
            grouped.top_share("subsidiary").alias("concentracion_sucursal"),
        )
        .where(F.col("total_trans") >= MIN_ROWS)
    )


def _hot_profile(hot: DataFrame) -> DataFrame:
    base = hot.groupBy(*KEY).agg(*_base_aggregates(), F.min(AMOUNT).alias("_lo"), F.max(AMOUNT).alias("_hi"))
    base = base.where(F.col("total_trans") >= MIN_ROWS)
    days = (
        hot.where(F.col(TS).isNotNull())
        .groupBy(*KEY, F.to_date(TS).alias("_day"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("dias_activos"))
    )
    ranged = hot.join(base.select(*KEY, "total_trans", "_lo", "_hi"), KEY)
    fullest = (
        ranged.withColumn("_bin", _amount_bin(F.col("total_trans"), F.col("_lo"), F.col("_hi")))
        .where(F.col("_bin").isNotNull())
        .groupBy(*KEY, "_bin")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*KEY)
        .agg(F.max("_n").alias("_fullest"))
    )
    gaps = grouped.hot_gaps(hot, KEY)
    median = exact_quantiles(gaps, "_gap", {"_median": 0.5}, by=KEY, weight="_weight")
    parts = [
        days,
        fullest,
        grouped.hot_gap_stats(gaps, KEY),
        median,
        *[grouped.hot_value_stats(hot, KEY, c) for c in COUNTED],
    ]
    rows = F.col("total_trans")
    zero = F.lit(0)
    return grouped.join_stats(base, parts, KEY).select(
        *KEY,
        "total_trans",
        "cv_monto",
        "concentracion_horaria",
        "pct_montos_exactos",
        "pct_montos_terminan_5",
        "monto_promedio",
        "monto_total",
        F.coalesce("dias_activos", zero).alias("dias_activos"),
        F.when(F.col("_gap_avg") > 0, F.col("_gap_std") / F.col("_gap_avg")).otherwise(0.0).alias("cv_intervalos"),
        F.coalesce("_median", F.lit(0.0)).alias("mediana_intervalo_min"),
        ratio_or_zero(F.col("_bursts"), F.col("_gaps")).alias("pct_rafagas"),
        (F.coalesce("_fullest", zero) / rows).alias("concentracion_montos"),
        F.coalesce("_distinct_merchant_id", zero).alias("comercios_unicos"),
        (F.col("_top_merchant_id") / rows).alias("concentracion_comercio"),
        F.coalesce("_distinct_subsidiary", zero).alias("sucursales_unicas"),
        (F.col("_top_subsidiary") / rows).alias("concentracion_sucursal"),
    )


def top_suspects(profile: DataFrame, n: int = 5) -> DataFrame:
    return profile.orderBy(F.desc("score_fraccionamiento"), "user_id").limit(n)


def critical_users(profile: DataFrame, above: float = CRITICAL_SCORE) -> DataFrame:
    return profile.where(F.col("score_fraccionamiento") > above)


def indicator_shares(profile: DataFrame) -> DataFrame:
    """Profiled users over each rule threshold, and means of three indicators: one row."""
    hits = {
        "low_cv": F.col("cv_monto") < LOW_CV,
        "hour_concentrated": F.col("concentracion_horaria") > HOUR_SHARE,
        "round_amounts": F.col("pct_montos_exactos") > ROUND_SHARE,
        "bursts": F.col("pct_rafagas") > BURST_SHARE,
        "single_merchant": F.col("comercios_unicos") == 1,
        "critical": F.col("score_fraccionamiento") > CRITICAL_SCORE,
    }
    users = F.count(F.lit(1))
    return profile.agg(
        users.alias("users"),
        *[F.count(F.when(hit, 1)).alias(f"n_{name}") for name, hit in hits.items()],
        *[F.try_divide(F.count(F.when(hit, 1)) * 100.0, users).alias(f"pct_{name}") for name, hit in hits.items()],
        F.avg("cv_monto").alias("mean_cv_monto"),
        F.avg("concentracion_horaria").alias("mean_concentracion_horaria"),
        F.avg("pct_montos_exactos").alias("mean_pct_montos_exactos"),
    )


MEDIAN_INDICATORS = [
    "cv_monto",
    "concentracion_horaria",
    "pct_montos_exactos",
    "pct_rafagas",
    "concentracion_montos",
    "score_fraccionamiento",
]


def indicator_medians(profile: DataFrame) -> DataFrame:
    """Median of each indicator over the profiled users, one row per indicator."""
    stacked = profile.unpivot([], MEDIAN_INDICATORS, "indicator", "_value")
    return exact_quantiles(stacked, "_value", {"median": 0.5}, by=["indicator"])


def short_gap_profiles(profile: DataFrame, minutes: float = 1440) -> DataFrame:
    """Profiles whose median gap is under a day."""
    return profile.where(F.col("mediana_intervalo_min") < minutes)


def profile_scatter(profile: DataFrame) -> DataFrame:
    return profile.select("user_id", "cv_monto", "concentracion_horaria", "score_fraccionamiento")
