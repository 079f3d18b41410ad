"""Distribution of amounts: summary, quantiles, bands and equal-width histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.functions import bands
from splitsight.operators.quantiles import exact_quantiles, value_counts
from splitsight.session import stored

AMOUNT = "transaction_amount"

# Fixed values.
AMOUNT_QUANTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75, "q90": 0.90, "q95": 0.95, "q99": 0.99}
AMOUNT_BANDS = [(100.0, "<=100"), (500.0, "100-500")]
AMOUNT_BAND_ABOVE = ">500"


def describe(df: DataFrame, column: str, probs: dict[str, float] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min, quantiles, max and number of distinct values: one row.

    ``df`` is read once: all of it follows from the rows per distinct value, which are stored.
    """
    probs = probs or {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    counted = stored(value_counts(df, column, []), "value-counts")
    value, n = F.col("_v").cast("double"), F.col("_n")
    mean = counted.agg(F.sum(value * n) / F.sum(n)).scalar()
    square = F.sum(n * F.pow(value - mean, 2))
    quantiles = exact_quantiles(counted, "_v", probs, weight="_n").select(F.struct("*"))
    moments = counted.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("count"),
        (F.sum(value * n) / F.sum(n)).alias("mean"),
        F.sqrt(F.try_divide(square, F.sum(n) - 1)).alias("std"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        F.count(F.lit(1)).alias("distinct_values"),
    )
    return moments.withColumn("_q", quantiles.scalar()).select("count", "mean", "std", "min", "_q.*", "max", "distinct_values")


def amount_quantiles(tx: DataFrame) -> DataFrame:
    return exact_quantiles(tx, AMOUNT, AMOUNT_QUANTILES)


def amount_bands(tx: DataFrame) -> DataFrame:
    """Transactions per amount band with the share of all rows, unreadable amounts included."""
    counted = tx.groupBy(
        F.coalesce(bands(F.col(AMOUNT), AMOUNT_BANDS, AMOUNT_BAND_ABOVE), F.lit("none")).alias("band")
    ).agg(F.count(F.lit(1)).alias("transactions"))
    total = counted.agg(F.sum("transactions")).scalar()
    return counted.where("band <> 'none'").withColumn("pct", F.col("transactions") * 100.0 / total)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max; every bin but the last is half-open.

    All bins are returned, empty ones with 0. If all values are equal the range is widened by 0.5
    on both sides. No row is returned if there is no value. ``df`` is read twice, for the range and
    for the counts.
    """
    value = F.col(column).cast("double")
    lo, hi = df.agg(F.min(value), F.max(value)).first()
    spine = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    if lo is None:
        spine, lo, hi = spine.limit(0), 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    guess = F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1))
    # The computed index may be one off for values on an edge.
    exact = (
        guess
        - (value < lo + guess * width).cast("long")
        + ((value >= lo + (guess + 1) * width) & (guess < bins - 1)).cast("long")
    )
    counted = (
        df.where(value.isNotNull()).groupBy(exact.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    )
    # Both sides have at most `bins` rows.
    return spine.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("bin_lo"),
        F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def unit_histogram(df: DataFrame, column: str) -> DataFrame:
    """One bin per integer from 1 to the maximum of the column."""
    counted = df.groupBy(F.col(column).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    top = counted.agg(F.max("bin")).first()[0] or 0
    spine = df.sparkSession.range(1, top + 1).withColumnRenamed("id", "bin")
    return spine.join(counted, "bin", "left").select("bin", F.coalesce("_n", F.lit(0)).alias("n"))
