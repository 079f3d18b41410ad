"""Coercion, deduplication and row filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from splitsight.functions import coerce_number, coerce_timestamp, to_ntz
from splitsight.operators.hotkeys import DEFAULT_HEAT, SORTED_ONCE, HeatLimit, dealt_by_heat, too_large
from splitsight.schema import DEBIT, KEEP_FIRST_ORDER


def coerce_transactions(raw: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """Typed dates and amounts; text that cannot be read becomes NULL, NaN becomes NULL.

    Dates are read as ISO text or by one of ``date_formats``.

    Columns that are typed already are not read as text, so filters on them reach the scan.
    """
    kinds = dict(raw.dtypes)
    ts, amount = F.col("transaction_date"), F.col("transaction_amount")
    coerced: dict[str, Column] = {}
    if kinds["transaction_date"] != "timestamp_ntz":
        text = kinds["transaction_date"] == "string"
        coerced["transaction_date"] = coerce_timestamp(ts, date_formats) if text else ts.cast("timestamp_ntz")
    if kinds["transaction_amount"] == "string":
        coerced["transaction_amount"] = coerce_number(amount)
    else:
        coerced["transaction_amount"] = F.nanvl(amount.cast("double"), F.lit(None).cast("double"))
    return raw.withColumns(coerced)


def drop_duplicate_ids(
    tx: DataFrame,
    within_day: bool = False,
    sizes_from: DataFrame | None = None,
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """Keeps the earliest row of each ``_id`` (of each ``_id`` and day with ``within_day``).

    Spark cuts every map partition to one row per id before the exchange (WindowGroupLimit), so an
    id with very many copies does not travel. NULL ids count as one id.

    A task sorts what one of the session's shuffle partitions holds. With ``sizes_from``, a table of about the same ids that is
    cheap to count, such as the rows before a join, a table too large for that is dealt to tasks by its rows; ids with
    very many copies are still cut before the exchange.
    """
    if sizes_from is None or not too_large(sizes_from):
        return _first_rows(tx, ["_id"], within_day).select(*tx.columns)
    # Unlike the id, its hash is never NULL; ids that share one go the same way and stay apart.
    key = F.xxhash64("_id").alias("_key")
    cold, hot = dealt_by_heat(tx.select("*", key), ["_key"], limit, sizes_from.select(key), times=SORTED_ONCE)
    first = _first_rows(cold, ["_key", "_id"], within_day)
    if hot is not None:
        first = first.unionByName(_first_rows(hot, ["_key", "_id"], within_day))
    return first.select(*tx.columns)


def _first_rows(rows: DataFrame, scope: list[str], within_day: bool) -> DataFrame:
    if within_day:
        rows = rows.withColumn("_day", F.to_date("transaction_date"))
        scope = [*scope, "_day"]
    order = [F.col(c).asc_nulls_last() for c in KEEP_FIRST_ORDER if c in rows.columns]
    first = F.row_number().over(W.partitionBy(*scope).orderBy(*order))
    return rows.withColumn("_rank", first).where("_rank = 1")


def on_day(tx: DataFrame, day: str | date) -> DataFrame:
    """Rows of one calendar day, as a half-open range that reaches the Parquet row groups."""
    return between_days(tx, day, day)


def between_days(tx: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Rows of the calendar days ``start`` to ``end``, both included."""
    ts = F.col("transaction_date")
    after = to_ntz(end) + F.expr("INTERVAL 1 DAY")
    return tx.where((ts >= to_ntz(start)) & (ts < after))


def debits(tx: DataFrame) -> DataFrame:
    return tx.where(F.col("transaction_type") == DEBIT)


def active_only(features: DataFrame, min_cnt: int = 10) -> DataFrame:
    """Groups with more than ``min_cnt`` transactions; no filter if the count column is missing."""
    if "cnt_24h" not in features.columns:
        return features
    return features.where(F.col("cnt_24h") > min_cnt)


def calendar_parts(tx: DataFrame) -> DataFrame:
    """Adds day, hour, minute and weekday (Monday = 0)."""
    ts = F.col("transaction_date")
    parts: dict[str, Column] = {
        "day": F.to_date(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "weekday": F.weekday(ts),
    }
    return tx.withColumns(parts)


def with_partition_columns(df: DataFrame, date_column: Column) -> DataFrame:
    """Adds zero-padded ``year``, ``month`` and ``day`` text columns."""
    return df.withColumns(
        {
            "year": F.date_format(date_column, "yyyy"),
            "month": F.date_format(date_column, "MM"),
            "day": F.date_format(date_column, "dd"),
        }
    )
