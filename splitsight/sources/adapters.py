"""Canonical transactions built from the ``events`` and ``lineitem``/``orders`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitsight.operators.hotkeys import dealt
from splitsight.schema import DEBIT

CREDIT = "CREDITO"
DEBIT_EVENTS = ["purchase", "click", "view"]
SECONDS_PER_DAY = 86400


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return events_as_transactions(spark.read.parquet(f"{folder}/events.parquet"))


def events_as_transactions(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.col("event_id").cast("string").alias("_id"),
        "user_id",
        F.col("ts").alias("transaction_date"),
        F.col("value").alias("transaction_amount"),
        F.when(F.col("event_type").isin(DEBIT_EVENTS), DEBIT).otherwise(CREDIT).alias("transaction_type"),
        (k % 10).alias("merchant_id"),
        (k % 3).alias("subsidiary"),
    )


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per order line; ids repeat, and the time of day follows from the keys.

    Lines are dealt by order, so that a task's share, which a deduplication sorts in place, doesn't grow with the table.
    """
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    lines = dealt(lines, lines.count(), "l_orderkey")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    second = (
        F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 1009 + F.col("l_partkey") * 31
    ) % SECONDS_PER_DAY
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "o_orderkey", "l_linenumber").alias("_id"),
        F.col("o_custkey").alias("user_id"),
        F.timestamp_add("SECOND", second.cast("int"), F.col("o_orderdate").cast("timestamp_ntz")).alias("transaction_date"),
        F.col("l_extendedprice").alias("transaction_amount"),
        F.when(F.col("l_returnflag") == "R", CREDIT).otherwise(DEBIT).alias("transaction_type"),
        F.col("l_suppkey").alias("merchant_id"),
        (F.col("l_suppkey") % 10).alias("subsidiary"),
    )


def order_line_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of ``order_transactions`` before the join with orders, to be counted or sampled."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return lines.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_id"))
