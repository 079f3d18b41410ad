"""Activity per user and day over all transaction types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.functions import bands
from splitsight.operators.hotkeys import DEFAULT_HEAT, SORTED_ONCE, HeatLimit, dealt_by_heat, too_large
from splitsight.operators.quantiles import exact_quantiles
from splitsight.session import stored

# Upper bounds and labels of the activity bands.
ACTIVITY_BANDS = [(1, "1"), (5, "2-5"), (10, "6-10"), (20, "11-20"), (50, "21-50"), (100, "51-100")]
ACTIVITY_ABOVE = ">100"


def user_day_counts(
    tx: DataFrame,
    sizes_from: DataFrame | None = None,
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """Transactions per user and calendar day as ``cnt_24h``.

    A task counts what one of the session's shuffle partitions holds. With ``sizes_from``, a table with the users of at least
    the rows of ``tx`` that is cheap to count, such as ``tx`` itself if it is stored, a table too large for that is dealt to
    tasks by its users; rows of hot users are still combined before the exchange.
    """
    days = tx.select("user_id", F.to_date("transaction_date").alias("date")).dropna()
    if sizes_from is None or not too_large(sizes_from):
        return _day_counts(days)
    users = sizes_from.select("user_id").dropna()
    cold, hot = dealt_by_heat(days, ["user_id"], limit, users, times=SORTED_ONCE)
    counts = _day_counts(cold)
    return counts if hot is None else counts.unionByName(_day_counts(hot))


def _day_counts(days: DataFrame) -> DataFrame:
    return days.groupBy("user_id", "date").agg(F.count(F.lit(1)).alias("cnt_24h"))


def user_day_summary(counts: DataFrame) -> DataFrame:
    """Cases, users, days, transactions, mean, median and maximum per user-day: one row.

    ``counts`` is stored, so that its source is read once.
    """
    counts = stored(counts, "user-day-counts")
    sizes = counts.groupBy("cnt_24h").agg(F.count(F.lit(1)).alias("_n"))
    median = exact_quantiles(sizes, "cnt_24h", {"p50": 0.5}, weight="_n")
    users = counts.select("user_id").distinct().agg(F.count(F.lit(1)))
    days = counts.select("date").distinct().agg(F.count(F.lit(1)))
    return counts.agg(
        F.count(F.lit(1)).alias("cases"),
        F.sum("cnt_24h").alias("transactions"),
        F.avg("cnt_24h").alias("mean_per_day"),
        F.max("cnt_24h").alias("max_per_day"),
    ).select(
        "cases",
        users.scalar().alias("users"),
        days.scalar().alias("days"),
        "transactions",
        "mean_per_day",
        median.scalar().alias("median_per_day"),
        "max_per_day",
    )


def activity_bands(counts: DataFrame) -> DataFrame:
    """User-days per band, with the share of all user-days and of those with more than one."""
    banded = counts.groupBy(bands(F.col("cnt_24h"), ACTIVITY_BANDS, ACTIVITY_ABOVE).alias("band")).agg(
        F.count(F.lit(1)).alias("cases")
    )
    total = banded.agg(F.sum("cases")).scalar()
    busy = banded.where("band <> '1'").agg(F.sum("cases")).scalar()
    return banded.select(
        "band",
        "cases",
        (F.col("cases") * 100.0 / total).alias("pct"),
        F.when(F.col("band") != "1", F.col("cases") * 100.0 / busy).alias("pct_of_active"),
    )


def activity_thresholds(counts: DataFrame) -> DataFrame:
    """User-days with exactly one, more than 1, 2-5, 6-10, more than 10 and more than 100."""
    n = F.col("cnt_24h")
    named = {
        "one": n == 1,
        "over_1": n > 1,
        "from_2_to_5": n.between(2, 5),
        "from_6_to_10": n.between(6, 10),
        "over_10": n > 10,
        "over_100": n > 100,
    }
    return counts.agg(
        F.count(F.lit(1)).alias("cases"),
        *[F.count(F.when(hit, 1)).alias(name) for name, hit in named.items()],
        (F.count(F.when(n == 1, 1)) * 100.0 / F.count(F.lit(1))).alias("pct_one"),
        (F.count(F.when(n > 1, 1)) * 100.0 / F.count(F.lit(1))).alias("pct_over_1"),
    )


def recurrent_users(counts: DataFrame, min_days: int = 5) -> DataFrame:
    """Number of users with more than ``min_days`` days of more than one transaction."""
    days = counts.where("cnt_24h > 1").groupBy("user_id").agg(F.count(F.lit(1)).alias("_days"))
    return days.where(F.col("_days") > min_days).agg(F.count(F.lit(1)).alias("recurrent_users"))


def top_user_days(counts: DataFrame, min_cnt: int = 100, n: int = 3) -> DataFrame:
    return (
        counts.where(F.col("cnt_24h") > min_cnt)
        .orderBy(F.desc("cnt_24h"), "user_id", "date")
        .limit(n)
    )


def consistent_users(counts: DataFrame, n: int = 5) -> DataFrame:
    """Users with most days of more than one transaction, with maximum and mean per such day."""
    return (
        counts.where("cnt_24h > 1")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("active_days"),
            F.max("cnt_24h").alias("max_per_day"),
            F.avg("cnt_24h").alias("mean_per_day"),
        )
        .orderBy(F.desc("active_days"), "user_id")
        .limit(n)
    )


def high_activity_days(counts: DataFrame, min_cnt: int = 10) -> DataFrame:
    return counts.where(F.col("cnt_24h") > min_cnt)


def persistent_users(
    counts: DataFrame, min_cnt: int = 10, min_days: int = 3, first: int | None = None
) -> DataFrame:
    """Users with at least ``min_days`` high-activity days; ``first`` keeps the most persistent."""
    users = (
        high_activity_days(counts, min_cnt)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("high_days"))
        .where(F.col("high_days") >= min_days)
    )
    if first is None:
        return users
    return users.orderBy(F.desc("high_days"), "user_id").limit(first)


def normal_users(tx: DataFrame, counts: DataFrame, min_cnt: int = 10, min_tx: int = 5) -> DataFrame:
    """Amount statistics of users without a high-activity day and with ``min_tx`` amounts or more.

    The anti-join runs on one row per user, after the aggregation.
    """
    active = high_activity_days(counts, min_cnt).select("user_id").distinct()
    stats = (
        tx.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.avg("transaction_amount").alias("amount_mean"),
            F.stddev_samp("transaction_amount").alias("amount_std"),
            F.count("transaction_amount").alias("tx_count"),
        )
        .where(F.col("tx_count") >= min_tx)
    )
    return stats.join(active, "user_id", "left_anti").withColumn(
        "amount_cv", F.try_divide("amount_std", "amount_mean")
    )


def compare_cv(profile: DataFrame, normal: DataFrame) -> DataFrame:
    """Average variation of amounts of profiled and of normal users: one row."""
    return profile.agg(F.avg("cv_monto").alias("active_cv")).select(
        "active_cv", normal.agg(F.avg("amount_cv")).scalar().alias("normal_cv")
    )


def day_spine(first: str, last: str, df: DataFrame) -> DataFrame:
    """Every calendar day between two dates, both included."""
    if last < first:
        raise ValueError("the last day lies before the first")
    return df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")
    )
