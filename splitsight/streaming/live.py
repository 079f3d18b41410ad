"""Structured Streaming: live windows, threshold alerts, deduplication, day scoring."""

from __future__ import annotations

import contextlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from splitsight.operators import alerts
from splitsight.operators.behaviour import user_day_features
from splitsight.operators.clean import active_only, debits, drop_duplicate_ids
from splitsight.operators.iforest import ForestModel
from splitsight.session import stored
from splitsight.sources import sinks
from splitsight.sources.transactions import read_days

TS = "transaction_date"
ALERT_COUNTS = {"Media": 10, "Alta": 50}


def with_event_time(stream: DataFrame) -> DataFrame:
    """Zone-free timestamps as instants, which watermarks need."""
    return stream.withColumn(TS, F.col(TS).cast("timestamp"))


def without_repeats(stream: DataFrame, watermark: str | None = None) -> DataFrame:
    """First row of each ``_id``.

    Without a watermark every id is remembered, on the executors' disks (``disk_state``); with one, ids are
    forgotten after it and late rows are dropped (``LateRows`` counts them).
    """
    if watermark is None:
        return stream.dropDuplicates(["_id"])
    return with_event_time(stream).withWatermark(TS, watermark).dropDuplicatesWithinWatermark(["_id"])


def _micros(spark: SparkSession, span: str) -> int:
    """Microseconds of a span such as ``24 hours``."""
    return round(spark.sql(f"select interval {span}").first()[0].total_seconds() * 1_000_000)


def _block_span(spark: SparkSession, window: str, slide: str | None, block: int) -> Column:
    """Blocks of ``block`` windows that start one after the other; a block ends with its last window."""
    if slide is None:
        return F.window(TS, window)
    if block == 1:
        return F.window(TS, window, slide)
    long, step = _micros(spark, window), _micros(spark, slide)
    return F.window(TS, f"{long + (block - 1) * step} microseconds", f"{block * step} microseconds")


def merchant_windows(
    stream: DataFrame,
    window: str = "24 hours",
    slide: str | None = "1 hour",
    watermark: str | None = "1 hour",
    block: int = 1,
) -> DataFrame:
    """Debit count and amount per user, merchant and window; ``slide=None`` gives tumbling windows.

    With ``block`` above 1 a row holds as many windows, from the one at the block's start on: ``rows_<i>`` (rows of any
    amount), ``cnt_<i>`` and ``sum_<i>``. A transaction is in ``window / slide`` windows, but in few blocks.
    """
    rows = with_event_time(debits(stream))
    if watermark is not None:
        rows = rows.withWatermark(TS, watermark)
    if slide is None or block == 1:
        span = _block_span(stream.sparkSession, window, slide, 1)
        return rows.groupBy(span, "user_id", "merchant_id").agg(
            F.count("transaction_amount").alias("cnt_24h"), F.sum("transaction_amount").alias("sum_24h")
        )
    spark = stream.sparkSession
    long, step = _micros(spark, window), _micros(spark, slide)
    rows = rows.withColumn("window", _block_span(spark, window, slide, block))
    after = F.unix_micros(TS) - F.unix_micros("window.start")
    found = []
    for i in range(block):
        inside = (after >= i * step) & (after < i * step + long)
        found += [
            F.count(F.when(inside, 1)).alias(f"rows_{i}"),
            F.count(F.when(inside, F.col("transaction_amount"))).alias(f"cnt_{i}"),
            F.sum(F.when(inside, F.col("transaction_amount"))).alias(f"sum_{i}"),
        ]
    return rows.groupBy("window", "user_id", "merchant_id").agg(*found)


def per_user(windows: DataFrame) -> DataFrame:
    """Count, amount and number of merchants per user and window, of rows per merchant."""
    return windows.groupBy("window", "user_id").agg(
        F.sum("cnt_24h").alias("cnt_24h"),
        F.coalesce(F.sum("sum_24h"), F.lit(0.0)).alias("sum_24h"),
        F.count("merchant_id").alias("merchants"),
    )


def _blocks_per_user(blocks: DataFrame, block: int) -> DataFrame:
    found = []
    for i in range(block):
        found += [
            F.sum(f"rows_{i}").alias(f"rows_{i}"),
            F.sum(f"cnt_{i}").alias(f"cnt_{i}"),
            F.sum(f"sum_{i}").alias(f"sum_{i}"),
            F.count(F.when(F.col(f"rows_{i}") > 0, F.col("merchant_id"))).alias(f"merchants_{i}"),
        ]
    return blocks.groupBy("window", "user_id").agg(*found)


def _single_windows(blocks: DataFrame, block: int, window: str, slide: str) -> DataFrame:
    """The windows of the blocks of users, one row each; a window without a row is none."""
    spark = blocks.sparkSession
    long, step = _micros(spark, window), _micros(spark, slide)
    start = F.unix_micros("window.start")

    def at(i: int) -> Column:
        return F.struct(
            F.struct(
                F.timestamp_micros(start + i * step).alias("start"), F.timestamp_micros(start + (i * step + long)).alias("end")
            ).alias("window"),
            F.col(f"rows_{i}").alias("rows"),
            F.col(f"cnt_{i}").alias("cnt_24h"),
            F.coalesce(f"sum_{i}", F.lit(0.0)).alias("sum_24h"),
            F.col(f"merchants_{i}").alias("merchants"),
        )

    told = blocks.select("user_id", F.inline(F.array(*[at(i) for i in range(block)])))
    return told.where(F.col("rows") > 0).select("window", "user_id", "cnt_24h", "sum_24h", "merchants")


# Windows that share a row of the state.
BLOCK = 8


def live_windows(
    stream: DataFrame,
    window: str = "24 hours",
    slide: str | None = "1 hour",
    watermark: str = "1 hour",
    block: int = BLOCK,
) -> DataFrame:
    """Debit count, amount and exact number of merchants per user and window.

    Two stateful steps in a row: windows per merchant, which hold one row per merchant instead of a list, feed windows
    per user when the watermark closes them. ``block`` windows in a row lie in one row of the state and close together,
    with the last of them: of 24-hour windows every hour, a transaction writes 4 rows at most instead of 24, and a window is told
    up to 7 hours later; ``block=1`` tells each one as it ends. A row is late, and dropped, if its block had ended at or before the
    watermark that the micro-batch before its own worked with, which comes from rows of batches still earlier: the
    first two batches drop nothing. ``LateRows`` counts what is dropped. A finite backlog is counted whole, in any order
    of its files, by ``backlog_windows``.
    """
    found = merchant_windows(stream, window, slide, watermark, block)
    if slide is None or block == 1:
        return per_user(found)
    return _single_windows(_blocks_per_user(found, block), block, window, slide)


def open_windows(spark: SparkSession, checkpoint: str, window: str = "24 hours", slide: str | None = "1 hour") -> DataFrame:
    """The windows that a stopped query of ``live_windows`` or ``backlog_windows`` still holds, read from its state.

    A row of the state is a row of the answer's sums, so this reads the checkpoint's last state only, and
    changes nothing in it: the query can go on, and then writes these windows itself when they close. ``window`` and ``slide``
    have to be those of the query; they matter if its state holds blocks of windows.
    """
    parts = []
    for (number,) in spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().collect():
        state = spark.read.format("statestore").option("operatorId", number).load(checkpoint)
        merchants = "merchant_id" in state.schema["key"].dataType.names
        width = len(state.schema["value"].dataType.names)
        names = [("cnt", "bigint"), ("sum", "double"), ("merchants", "bigint")][: 2 if merchants else 3]
        if width == len(names):
            fields = ",".join(f"{n}_24h:{kind}" if n != "merchants" else f"{n}:{kind}" for n, kind in names)
        else:
            block = width // (len(names) + 1)
            fields = ",".join(f"{n}_{i}:{kind}" for i in range(block) for n, kind in [("rows", "bigint"), *names])
        held = state.select("key.*", F.col("value").cast(f"struct<{fields}>").alias("_held")).select("*", "_held.*").drop("_held")
        if width == len(names):
            parts.append(per_user(held) if merchants else held.select("window", "user_id", "cnt_24h", "sum_24h", "merchants"))
        else:
            parts.append(_single_windows(_blocks_per_user(held, block) if merchants else held, block, window, slide))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    # A window is in one of the two states.
    return found.withColumn("sum_24h", F.coalesce("sum_24h", F.lit(0.0)))


class LateRows(StreamingQueryListener):
    """Counts the rows that each query drops for being late, from all its progress reports."""

    def __init__(self, spark: SparkSession):
        self._spark, self._dropped = spark, Counter()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._dropped[str(event.progress.id)] += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        """Dropped rows of a query so far; reports on their way are waited for."""
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        return self._dropped[str(query.id)]

    def close(self) -> None:
        self._spark.streams.removeListener(self)


STATE_MB = 500
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Counting the rows of the state takes a look-up for each write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextlib.contextmanager
def disk_state(spark: SparkSession, memory_mb: int = STATE_MB) -> Iterator[None]:
    """Queries started inside keep their state on disk, with at most ``memory_mb`` of it in an executor's memory.

    A micro-batch adds its changes to the checkpoint, not the whole state. A query that was begun with another
    kind of state keeps that one.
    """
    wanted = DISK_STATE | {"spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(memory_mb)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def threshold_alerts(windows: DataFrame, counts: dict[str, int] = ALERT_COUNTS) -> DataFrame:
    """Windows above the lowest count, with the label of the highest count they exceed."""
    ordered = sorted(counts.items(), key=lambda item: item[1])
    label = F.lit(None).cast("string")
    for name, bound in ordered:
        label = F.when(F.col("cnt_24h") > bound, name).otherwise(label)
    return windows.withColumn("alert", label).where(F.col("alert").isNotNull())


def to_table(stream: DataFrame, path: str, checkpoint: str, finish: bool = False, memory_mb: int = STATE_MB) -> StreamingQuery:
    """Appends finished windows to a Parquet table, exactly once.

    ``finish`` processes what is there and stops; ``all_windows`` then adds what is still open.
    """
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    with disk_state(stream.sparkSession, memory_mb):
        return (writer.trigger(availableNow=True) if finish else writer).start(path)


def all_windows(
    spark: SparkSession, path: str, checkpoint: str, window: str = "24 hours", slide: str | None = "1 hour"
) -> DataFrame:
    """The windows that a stopped query of ``live_windows`` has written, and those that it still holds.

    ``window`` and ``slide`` as for ``open_windows``.
    """
    held = open_windows(spark, checkpoint, window, slide)
    return spark.read.schema(held.schema).parquet(path).unionByName(held)


def backlog_windows(
    stream: DataFrame,
    checkpoint: str,
    window: str = "24 hours",
    slide: str | None = "1 hour",
    memory_mb: int = STATE_MB,
    block: int = BLOCK,
) -> DataFrame:
    """All windows over the files that are there, in any order: nothing is late.

    The micro-batches write nothing; the windows are read from the state after the last one.
    """
    counted = merchant_windows(stream, window, slide, watermark=None, block=block)
    writer = counted.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    with disk_state(stream.sparkSession, memory_mb):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return open_windows(stream.sparkSession, checkpoint, window, slide)


def score_into(
    stream: DataFrame,
    clean_path: str,
    scores_path: str,
    checkpoint: str,
    model: ForestModel,
    min_cnt: int = 10,
    finish: bool = False,
) -> StreamingQuery:
    """Keeps clean days and a log of scores current, one micro-batch at a time; ``current_alerts`` reads them.

    Both tables are partitioned by day and micro-batch, and a batch writes its own partitions only. Of the days it
    touches, the rows of the user-days that it touches are read back, deduplicated, featurised and scored once more;
    the newest score of a user-day counts. A batch that failed at any point has changed no partition
    of another one, and is repeated over its own.
    """
    key = ["user_id", "date"]

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        rows = stored(batch.where(F.col(TS).isNotNull()), "live-batch")
        touched = stored(rows.select("user_id", F.to_date(TS).alias("date")).distinct(), "touched")
        # Calendar days in one batch: a short list, so that only their folders are read.
        days = [r["date"] for r in touched.select("date").distinct().collect()]
        if not days:
            return
        sinks.write_batch(rows, clean_path, TS, batch_id)
        kept = read_days(spark, clean_path, days).select(*rows.columns).withColumn("date", F.to_date(TS))
        kept = kept.join(touched, key, "left_semi").drop("date")
        features = active_only(user_day_features(drop_duplicate_ids(kept, within_day=True)), min_cnt)
        sinks.write_batch(alerts.scored_rows(features, model), scores_path, "date", batch_id)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if finish else writer).start()


def current_alerts(scores: DataFrame, contamination: float) -> DataFrame:
    """The alert rows that follow from a log of scores, whole or some of its days.

    Of a user-day the newest score counts; a day's threshold comes from the scores that count.
    """
    columns = [c for c in scores.columns if c not in ("user_id", "date", sinks.BATCH, *sinks.DAY_PARTITIONS)]
    newest = scores.groupBy("user_id", "date").agg(F.max_by(F.struct(*columns), sinks.BATCH).alias("newest"))
    return alerts.flagged(stored(newest.select("user_id", "date", "newest.*"), "live-scores"), contamination)
