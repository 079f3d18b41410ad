"""Data-quality profile of a transaction table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitsight.functions import to_ntz
from splitsight.schema import KEEP_FIRST_ORDER

# Fixed values.
HEX_ID = r"^[0-9a-f]+$"
NON_HEX_CHARACTER = r"[^0-9a-fA-F]"
# Fixed values, as defaults.
SHOW_ALL_UP_TO = 20
SHOW_FIRST = 5
EXAMPLES = 5


def text_cardinality(df: DataFrame, show_all_up_to: int = SHOW_ALL_UP_TO, show_first: int = SHOW_FIRST) -> DataFrame:
    """Distinct values of each text column, with all values if there are few, else the first ones.

    Values are counted per (column, value) with a map-side combine; the rank filter leaves at most
    ``show_all_up_to`` rows per column and map partition before the second exchange.
    """
    columns = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    stacked = df.select(*columns).unpivot([], columns, "column", "value")
    distinct = stacked.where(F.col("value").isNotNull()).distinct()
    counts = distinct.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    rank = F.row_number().over(W.partitionBy("column").orderBy("value"))
    samples = (
        distinct.withColumn("_rank", rank)
        .where(F.col("_rank") <= max(show_all_up_to, show_first))
        .groupBy("column")
        .agg(F.sort_array(F.collect_list("value")).alias("_values"))
    )
    shown = F.when(F.col("distinct_values") <= show_all_up_to, F.col("_values")).otherwise(
        F.slice("_values", 1, show_first)
    )
    return counts.join(samples, "column").select("column", "distinct_values", shown.alias("values"))


def day_sketches(df: DataFrame, columns: list[str], day: str, accuracy: int = 12) -> DataFrame:
    """A distinct-count sketch of each column for each day: (day, one binary column per column).

    Sketches of any days can be merged (``merged_cardinality``), so a stored table of them answers for every range without
    the rows. With 2 ** ``accuracy`` registers the standard error is about 0.83 / sqrt(2 ** accuracy), 1.3 % for 12.
    """
    return df.groupBy(F.to_date(day).alias("day")).agg(*[F.hll_sketch_agg(F.col(c), accuracy).alias(c) for c in columns])


def merged_cardinality(sketches: DataFrame) -> DataFrame:
    """(column, distinct_values): estimates over all days of a table of sketches; NULLs don't count."""
    columns = [c for c in sketches.columns if c != "day"]
    merged = sketches.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in columns])
    return merged.unpivot([], columns, "column", "distinct_values")


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count per column, from one pass."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_profile(df).agg(F.count(F.when(F.col("nulls") > 0, 1)).alias("columns_with_nulls"))


def id_counts(tx: DataFrame) -> DataFrame:
    return tx.groupBy("_id").agg(F.count(F.lit(1)).alias("copies"))


def duplicate_count(tx: DataFrame) -> DataFrame:
    """Rows, distinct ids, ids that repeat and surplus rows (rows minus ids; NULL is one id)."""
    return id_counts(tx).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("ids"),
        F.count(F.when(F.col("copies") > 1, 1)).alias("repeated_ids"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
    )


def duplicate_ids(tx: DataFrame) -> DataFrame:
    return id_counts(tx).where("copies > 1")


def duplicate_rows(tx: DataFrame) -> DataFrame:
    """All rows of ids that repeat, sorted by id.

    The semi-join compares NULL ids as equal; AQE splits an id with very many copies, and the sort
    on all columns lets the range partitioning split it too.
    """
    repeated = duplicate_ids(tx).select(F.col("_id").alias("_dup"))
    order = [c for c in ["_id", *KEEP_FIRST_ORDER] if c in tx.columns]
    return tx.join(repeated, F.col("_id").eqNullSafe(F.col("_dup")), "left_semi").orderBy(*order)


def nonpositive_amounts(tx: DataFrame) -> DataFrame:
    bad = F.count(F.when(F.col("transaction_amount") <= 0, 1))
    return tx.agg(
        F.count(F.lit(1)).alias("rows"),
        bad.alias("nonpositive"),
        F.try_divide(bad * 100.0, F.count(F.lit(1))).alias("pct"),
    )


def date_range_check(
    tx: DataFrame, first: str | date | datetime | None = None, last: str | date | datetime | None = None
) -> DataFrame:
    """Earliest and latest date, and rows outside ``[first, last]``.

    A bound that is not given is the table's own, which nothing can lie outside of.
    """
    ts = F.col("transaction_date")
    outside: Column = F.lit(False)
    if first is not None:
        outside = outside | (ts < to_ntz(first))
    if last is not None:
        outside = outside | (ts > to_ntz(last))
    bad = F.count(F.when(outside, 1))
    return tx.agg(
        F.min(ts).alias("first_date"),
        F.max(ts).alias("last_date"),
        bad.alias("outside"),
        F.try_divide(bad * 100.0, F.count(F.lit(1))).alias("pct_outside"),
    )


def id_lengths(tx: DataFrame) -> DataFrame:
    """Ids per length with the share of all rows, sorted by length."""
    counted = tx.groupBy(F.length("_id").alias("length")).agg(F.count(F.lit(1)).alias("ids"))
    total = counted.agg(F.sum("ids")).scalar()
    return (
        counted.where(F.col("length").isNotNull())
        .withColumn("pct", F.col("ids") * 100.0 / total)
        .orderBy("length")
    )


def not_hex(col: str = "_id") -> Column:
    """True for ids that are not lower-case hex; a NULL id is one of them."""
    return ~F.coalesce(F.col(col).rlike(HEX_ID), F.lit(False))


def has_special(col: str = "_id") -> Column:
    """True for ids with a character that is no hex digit; false for a NULL id."""
    return F.coalesce(F.col(col).rlike(NON_HEX_CHARACTER), F.lit(False))


def id_format_check(tx: DataFrame) -> DataFrame:
    """Ids that break either format rule: one row."""
    return tx.agg(
        F.count(F.when(not_hex(), 1)).alias("not_hex"),
        F.count(F.when(has_special(), 1)).alias("with_special"),
    )


def id_format_examples(tx: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """The first ``n`` offending ids of each rule, NULL first."""
    found = []
    for rule, hit in (("not_hex", not_hex()), ("with_special", has_special())):
        worst = tx.where(hit).select("_id").orderBy(F.asc_nulls_first("_id")).limit(n)
        found.append(worst.select(F.lit(rule).alias("rule"), "_id"))
    return found[0].unionByName(found[1])


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )
