"""Exact linear-interpolation quantiles without gathering the values in one task.

Values are first counted per distinct value, then spread over buckets whose edges are approximate
quantiles of the distinct values. Bucket totals tell which buckets hold the wanted ranks; only those go on, and
are spread over buckets again until none has more than ``MOST_VALUES`` distinct values. Those are ordered. The edges
only decide how evenly work is spread: the result is exact for any edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from splitsight.session import stored

# Buckets in a session with few shuffle partitions; others use as many as partitions, up to a bound.
BUCKETS, MOST_BUCKETS = 64, 4096
# Distinct values of a bucket that are ordered together.
MOST_VALUES = 1_000_000


def bucket_steps(df: DataFrame) -> list[int]:
    """Halving steps of the bucket search: they reach twice as many buckets as the first says."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [BUCKETS // 2]
    while 2 * steps[0] < min(partitions, MOST_BUCKETS):
        steps.insert(0, 2 * steps[0])
    return [*steps, *[steps[-1] >> k for k in range(1, steps[-1].bit_length())]]


def value_counts(df: DataFrame, value: str, by: list[str], weight: str | None = None) -> DataFrame:
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(rows.cast("long").alias("_n"))
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: list[str] | None = None,
    weight: str | None = None,
    most: int = MOST_VALUES,
) -> DataFrame:
    """One row per group with one column per entry of ``probs``; NULL values are left out.

    ``by`` has to be non-null keys. Without ``by`` there is exactly one row, all NULL when there is no value. A table that
    could leave more than ``most`` values in a bucket is narrowed down in rounds, with a job for each; the rows of a
    round are stored. For others the first round does, and no job is run here.
    """
    by = by or []
    steps = bucket_steps(df)
    rows = value_counts(df, value, by, weight)
    large = _at_most(df) > 2 * steps[0] * most
    rows = (stored(rows, "value-counts") if large else rows).withColumn("_bucket", F.lit(0).cast("long"))
    wanted = None
    while True:
        spread = _spread(rows, [*by, "_bucket"], steps)
        spread = stored(spread, "value-buckets") if large else spread
        wanted = _wanted(spread, by, probs, wanted)
        rows = spread.withColumn("_bucket", _inside(steps)).drop("_within").join(wanted, [*by, "_bucket"])
        if not large:
            break
        wanted = stored(wanted, "value-wanted")
        rows = stored(rows, "value-counts")
        # A bucket of one value can't be split, and needs no more.
        if (wanted.agg(F.max("_values")).first()[0] or 0) <= most:
            break
        rows = rows.select(*by, "_v", "_n", "_bucket")
    return _interpolated(rows, by, probs)


def _at_most(df: DataFrame) -> int:
    """Rows that a table can have by Spark's estimate of its bytes: one a byte."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _inside(steps: list[int]) -> Column:
    """The number of a bucket within a bucket."""
    return F.col("_bucket") * (2 * steps[0]) + F.col("_within")


def _spread(rows: DataFrame, group: list[str], steps: list[int]) -> DataFrame:
    """``rows`` with ``_within``, one of twice ``steps[0]`` buckets inside the group."""
    buckets = 2 * steps[0]
    cuts = F.expr(f"array({', '.join(f'{i / buckets}D' for i in range(1, buckets))})")
    edges = rows.groupBy(*group).agg(F.percentile_approx("_v", cuts, F.lit(16 * buckets)).alias("_cuts"))
    spread = rows.join(edges, group)
    # Number of edges below the value, by binary search in generated code.
    spread = spread.withColumn("_within", F.lit(0))
    for step in steps:
        below = F.get("_cuts", F.col("_within") + (step - 1)) < F.col("_v")
        spread = spread.withColumn("_within", F.col("_within") + F.when(below, step).otherwise(0))
    return spread.drop("_cuts")


def _position(probs: dict[str, float]) -> dict[str, Column]:
    return {name: F.lit(p) * (F.col("_total") - 1) for name, p in probs.items()}


def _wanted(spread: DataFrame, by: list[str], probs: dict[str, float], earlier: DataFrame | None) -> DataFrame:
    """(by, _bucket, _before, _total, _values): buckets that hold a wanted rank, rows before them, distinct values."""
    steps = bucket_steps(spread)
    # At most one row per bucket and group from here.
    sized = spread.groupBy(*by, "_bucket", "_within").agg(F.sum("_n").alias("_in"), F.count("*").alias("_values"))
    before = W.partitionBy(*by, "_bucket").orderBy("_within").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    if earlier is None:
        placed = placed.withColumn("_total", F.sum("_in").over(W.partitionBy(*by)))
    else:
        known = earlier.select(*by, "_bucket", F.col("_before").alias("_first"), "_total")
        placed = placed.join(known, [*by, "_bucket"]).withColumn("_before", F.col("_before") + F.col("_first"))
    ranks = [f(position).cast("long") for position in _position(probs).values() for f in (F.floor, F.ceil)]
    holds = reduce(
        lambda a, b: a | b,
        [(F.col("_before") <= r) & (r < F.col("_before") + F.col("_in")) for r in ranks],
    )
    return placed.where(holds).select(*by, _inside(steps).alias("_bucket"), "_before", "_total", "_values")


def _interpolated(rows: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    """The quantiles from the values of the wanted buckets, which are ordered."""
    inside = W.partitionBy(*by, "_bucket").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ordered = rows.withColumn("_to", F.col("_before") + F.sum("_n").over(inside)).withColumn("_from", F.col("_to") - F.col("_n"))
    position = _position(probs)

    def value_at(rank):
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v")))

    found = []
    for name in probs:
        low = value_at(F.floor(position[name])).cast("double")
        high = value_at(F.ceil(position[name])).cast("double")
        part = F.max(position[name] - F.floor(position[name]))
        found.append((low + (high - low) * part).alias(name))
    return ordered.groupBy(*by).agg(*found)
