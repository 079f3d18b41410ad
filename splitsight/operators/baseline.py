"""Historical means and deviations per user and over everyone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.schema import BASELINE_METRICS


def _moments() -> list:
    return [
        F.expr(f"{f}({m}) AS {m}_{name}")
        for m in BASELINE_METRICS
        for name, f in (("mean", "avg"), ("std", "stddev_samp"))
    ]


def user_baseline(anchors: DataFrame) -> DataFrame:
    """Mean and sample deviation over the anchors of each user; one anchor gives a NULL deviation."""
    return anchors.groupBy("user_id").agg(*_moments())


def global_baseline(anchors: DataFrame) -> DataFrame:
    """The same numbers over all (user, anchor) rows: one row."""
    return anchors.agg(*_moments())


def fallback_baseline(history: DataFrame) -> DataFrame:
    """For a history that no anchor window touches: spread of whole-period totals over users."""
    per_user = history.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("transaction_amount").alias("cnt_24h"),
        F.coalesce(F.sum("transaction_amount"), F.lit(0.0)).alias("sum_24h"),
        F.avg("transaction_amount").alias("avg_amount"),
    )
    return per_user.agg(
        *[
            f(m).alias(f"{m}_{name}")
            for m in ("cnt_24h", "sum_24h", "avg_amount")
            for name, f in (("mean", F.avg), ("std", F.stddev_samp))
        ]
    )


def shared_baseline(anchors: DataFrame, history: DataFrame | None = None) -> dict[str, float | None]:
    """Mean and deviation for users without anchors: one row, read by the driver.

    The global row if any anchor row exists. Otherwise the fallback row of ``history``; metrics it
    lacks, or all of them without ``history``, get mean 0 and deviation 1.
    """
    found = anchors.agg(F.count(F.lit(1)).alias("rows"), *_moments()).first().asDict()
    if found.pop("rows") > 0:
        return found
    defaults = {name: 0.0 if name.endswith("_mean") else 1.0 for name in found}
    if history is None:
        return defaults
    spare = fallback_baseline(history).first().asDict()
    return {name: default if spare.get(name) is None else spare[name] for name, default in defaults.items()}


def with_baseline(
    features: DataFrame,
    anchors: DataFrame,
    history: DataFrame | None = None,
    single_window: str = "null",
) -> DataFrame:
    """Adds ``<m>_mean`` and ``<m>_std`` for each metric with a baseline.

    Users with anchors use their own numbers, others the shared ones. ``single_window="global"``
    replaces the undefined deviation of one-anchor users by the shared one; the default keeps it
    NULL. ``anchors`` is read twice: pass a stored table.
    """
    if single_window not in ("null", "global"):
        raise ValueError("single_window is 'null' or 'global'")
    shared = shared_baseline(anchors, history)
    own = user_baseline(anchors).select("user_id", F.struct(*shared).alias("_u"))
    resolved = {}
    for name, value in shared.items():
        other = F.lit(value).cast("double")
        mine = F.col(f"_u.{name}")
        if single_window == "global" and name.endswith("_std"):
            mine = F.coalesce(mine, other)
        resolved[name] = F.when(F.col("_u").isNotNull(), mine).otherwise(other)
    return features.join(own, "user_id", "left").withColumns(resolved).drop("_u")
