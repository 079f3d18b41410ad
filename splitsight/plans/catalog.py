"""Named queries over the test tables: one per operator or small group of operators.

Thresholds are lower than the defaults, since no user-day of these tables has more than ten
transactions.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitsight.functions import to_ntz
from splitsight.operators import activity, alerts, amounts, baseline, clean, iforest, profile, quality
from splitsight.operators import suspicion, windows
from splitsight.operators.behaviour import user_day_features
from splitsight.operators.hotkeys import DEFAULT_HEAT, HeatLimit
from splitsight.operators.idindex import IdIndex
from splitsight.plans import backfill, detect, explore
from splitsight.schema import MODEL_FEATURES
from splitsight.session import scratch_path, stored
from splitsight.sources import sinks, transactions
from splitsight.sources.adapters import event_transactions, events_as_transactions, order_line_ids, order_transactions
from splitsight.streaming import live

Query = Callable[[SparkSession, str], DataFrame]

MIN_CNT = 3
DIGITS = 6
# Keeps exact decimal ties (cents divided by a power of two) on one side in every engine.
OFF_TIES = 1e-8
RANGE = ("2024-01-04", "2024-01-23")
QUIET_DAY = "2024-01-10"
# Shows the way of hot keys on every key.
ALL_HOT = HeatLimit(0)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded for output, so that summation order does not show; no negative zero."""
    return df.select(
        *[
            (F.round(F.col(name) + OFF_TIES, DIGITS) + 0.0).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# ---------------------------------------------------------------- inputs


def txe(spark: SparkSession, folder: str) -> DataFrame:
    return event_transactions(spark, folder)


def txr(spark: SparkSession, folder: str) -> DataFrame:
    """Order transactions before deduplication."""
    return order_transactions(spark, folder)


def txo(spark: SparkSession, folder: str, within_day: bool = False) -> DataFrame:
    return clean.drop_duplicate_ids(txr(spark, folder), within_day, sizes_from=order_line_ids(spark, folder))


def clean_o(spark: SparkSession, folder: str) -> DataFrame:
    """The deduplicated table as a batch job leaves it, for queries that read it more than once."""
    return stored(txo(spark, folder), "clean")


def counts_e(spark: SparkSession, folder: str) -> DataFrame:
    return activity.user_day_counts(txe(spark, folder))


def counts_o(spark: SparkSession, folder: str) -> DataFrame:
    return activity.user_day_counts(txo(spark, folder))


def with_mixed_ids(tx: DataFrame) -> DataFrame:
    """Hex ids, with some in capitals, some not hashed and some missing."""
    order = F.substring_index("_id", "-", 1).cast("long")
    return tx.withColumn(
        "_id",
        F.when(order % 5 == 0, F.upper(F.md5("_id")))
        .when(order % 7 == 0, F.col("_id"))
        .when(order % 11 == 0, F.lit(None))
        .otherwise(F.md5("_id")),
    )


def with_holes(tx: DataFrame) -> DataFrame:
    """Some dates, amounts and merchants missing."""
    event = F.col("_id").cast("long")
    return tx.withColumns(
        {
            "transaction_date": F.when(event % 11 != 0, F.col("transaction_date")),
            "transaction_amount": F.when(event % 7 != 0, F.col("transaction_amount")),
            "merchant_id": F.when(event % 5 != 0, F.col("merchant_id")),
        }
    )


def as_text(tx: DataFrame) -> DataFrame:
    """Raw text rows, some of them unreadable."""
    event = F.col("_id").cast("long")
    amount = F.col("transaction_amount").cast("string")
    return tx.select(
        "_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.when(event % 11 == 0, "no date").otherwise(F.col("transaction_date").cast("string")).alias("transaction_date"),
        F.when(event % 7 == 0, "n/a")
        .when(event % 7 == 1, "NaN")
        .when(event % 7 == 2, F.concat(amount, F.lit("d")))
        .otherwise(amount)
        .alias("transaction_amount"),
        "transaction_type",
        F.col("merchant_id").cast("string").alias("merchant_id"),
        F.col("subsidiary").cast("string").alias("subsidiary"),
    )


def day_features_o(spark: SparkSession, folder: str) -> DataFrame:
    return user_day_features(clean_o(spark, folder))


def active_features(spark: SparkSession, folder: str) -> DataFrame:
    """Active user-days, written once: fitting reads them several times."""
    return stored(clean.active_only(day_features_o(spark, folder), MIN_CNT), "active")


def profiles(spark: SparkSession, folder: str, first: int | None = None, limit: HeatLimit = DEFAULT_HEAT) -> DataFrame:
    return explore.persistent_profile(clean_o(spark, folder), MIN_CNT, first=first, limit=limit)


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return detect.suspicion_report(txe(spark, folder))


# ---------------------------------------------------------------- queries


def source_union_counts(spark: SparkSession, folder: str) -> DataFrame:
    first, second = txe(spark, folder), txr(spark, folder)
    both = transactions.union_strict(first, second).agg(F.count(F.lit(1)).alias("rows"))
    return transactions.row_counts(events=first, orders=second).unionByName(both.select(F.lit("both").alias("source"), "rows"))


def coerced_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clean.coerce_transactions(as_text(txe(spark, folder))))


def coerced_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Dates as ISO text, day first, and month first with a name."""
    tx = txe(spark, folder)
    event, ts = F.col("_id").cast("long"), F.col("transaction_date")
    text = (
        F.when(event % 3 == 0, F.date_format(ts, "dd/MM/yyyy HH:mm:ss.SSSSSS"))
        .when(event % 3 == 1, F.date_format(ts, "MMM d yyyy HH:mm:ss.SSSSSS"))
        .otherwise(ts.cast("string"))
    )
    formats = ["dd/MM/yyyy HH:mm:ss.SSSSSS", "MMM d yyyy HH:mm:ss.SSSSSS"]
    return rounded(clean.coerce_transactions(tx.withColumn("transaction_date", text), formats))


def one_day_debits(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(clean.debits(clean.on_day(txe(spark, folder), "2024-01-15")))


def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.calendar_parts(txe(spark, folder)).groupBy("weekday", "hour").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.max("minute").cast("long").alias("last_minute"),
        F.min("day").alias("first_day"),
    )
    return rows.withColumns({c: F.col(c).cast("long") for c in ("weekday", "hour")})


def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_profile(with_holes(txe(spark, folder)))


def columns_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return quality.columns_with_nulls(with_holes(txe(spark, folder)))


def text_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.text_cardinality(txr(spark, folder))
    return found.withColumn("values", F.array_join("values", "|"))


TS = windows.TS
SKETCHED = {"_id": "string", "user_id": "string", "merchant_id": "string"}


def sketched_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct values in a range of days from the sketches of its days, beside the exact numbers."""
    tx = txe(spark, folder).select(TS, *[F.col(c).cast(kind).alias(c) for c, kind in SKETCHED.items()])
    sketches = stored(quality.day_sketches(tx, list(SKETCHED), TS), "day-sketches")
    first, last = (F.lit(d).cast("date") for d in RANGE)
    estimated = quality.merged_cardinality(sketches.where((F.col("day") >= first) & (F.col("day") <= last)))
    exact = clean.between_days(tx, *RANGE).agg(*[F.count_distinct(c).alias(c) for c in SKETCHED])
    exact = exact.unpivot([], list(SKETCHED), "column", "exact")
    within = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact")
    return exact.join(estimated, "column").select("column", "exact", within.alias("within_5_pct"))


def dedup_in_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The table cleaned in two batches, early dates first, with an index of the ids kept."""
    tx = txr(spark, folder)
    early = F.coalesce(F.col(TS) < F.lit("1995-06-01").cast("timestamp_ntz"), F.lit(False))
    with IdIndex(spark, scratch_path(spark, "ids")) as index:
        first = index.add(tx.where(early), "early")
        return rounded(first.unionByName(index.add(tx.where(~early), "late")))


def patterned(tx: DataFrame) -> DataFrame:
    """Six of seven users get one habit each that a rule of the score looks for."""
    amount, habit = F.col("transaction_amount"), F.col("user_id") % 7
    second = "(hour(transaction_date) * 3600 + minute(transaction_date) * 60 + second(transaction_date))"
    day = "cast(to_date(transaction_date) as timestamp_ntz)"
    in_one_hour = F.expr(f"{day} + make_dt_interval(0, 10, 0, {second} div 24)")
    in_one_minute = F.expr(f"{day} + make_dt_interval(0, 0, 0, {second} div 1440)")
    part = amount / 10000
    return tx.withColumns(
        {
            "transaction_amount": F.when(habit == 0, amount / 100000 + 100)
            .when(habit == 3, F.floor(amount / 10) * 10)
            .when(habit == 5, part * part * part * part * part * part)
            .otherwise(amount),
            TS: F.when(habit == 1, in_one_hour).when(habit == 2, in_one_minute).otherwise(F.col(TS)),
            "merchant_id": F.when(habit == 4, 1).otherwise(F.col("merchant_id")),
        }
    )


def structuring_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of users of whom some hit each rule."""
    return rounded(explore.persistent_profile(stored(patterned(txo(spark, folder)), "patterned"), MIN_CNT))


def flagged_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Only the flagged rows of the alert file."""
    out = scratch_path(spark, "flagged")
    found = forest_alerts(spark, folder)
    sinks.write_alerts_csv(found, out, flagged_only=True)
    return rounded(spark.read.schema(found.schema).option("header", True).csv(out).select(*alerts.ALERT_COLUMNS))


def spread_counts(spark: SparkSession, folder: str) -> DataFrame:
    """User-day counts stretched so that every band of activity occurs."""
    n = F.col("cnt_24h")
    return counts_e(spark, folder).withColumn("cnt_24h", F.when(n <= 5, n * n).when(n == 6, 64).otherwise(n * n * n))


def amount_describe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(amounts.describe(clean_o(spark, folder), "transaction_amount"))


def count_histograms(spark: SparkSession, folder: str) -> DataFrame:
    counts = stored(counts_o(spark, folder))
    parts = {
        "all": (counts, 50),
        "active": (counts.where("cnt_24h > 1"), 30),
        "middle": (counts.where("cnt_24h between 2 and 20"), 19),
        "extreme": (counts.where("cnt_24h > 5"), 20),
    }
    result = None
    for name, (part, bins) in parts.items():
        one = amounts.histogram(part, "cnt_24h", bins).withColumn("part", F.lit(name))
        result = one if result is None else result.unionByName(one)
    return rounded(result)


def profile_histograms(spark: SparkSession, folder: str) -> DataFrame:
    found = stored(profiles(spark, folder))
    result = None
    for column in profile.MEDIAN_INDICATORS:
        one = amounts.histogram(found, column, 25).withColumn("indicator", F.lit(column))
        result = one if result is None else result.unionByName(one)
    gaps = amounts.histogram(profile.short_gap_profiles(found), "mediana_intervalo_min", 25)
    return rounded(result.unionByName(gaps.withColumn("indicator", F.lit("mediana_intervalo_min"))))


def normal_vs_active_cv(spark: SparkSession, folder: str) -> DataFrame:
    tx = clean_o(spark, folder)
    normal = activity.normal_users(tx, activity.user_day_counts(tx, sizes_from=tx), MIN_CNT)
    return rounded(activity.compare_cv(explore.persistent_profile(tx, MIN_CNT, first=None), normal))


def daily_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Every day from the first to the last transaction, with its number of transactions."""
    tx = clean_o(spark, folder)
    day = F.to_date("transaction_date").alias("date")
    ends = tx.agg(F.min("transaction_date").alias("a"), F.max("transaction_date").alias("b")).first()
    spine = activity.day_spine(ends.a.date().isoformat(), ends.b.date().isoformat(), tx)
    counted = tx.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counted, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("transactions"))


def features_in_range(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "features")
    sinks.write_feature_days(user_day_features(txe(spark, folder)), path)
    kept = transactions.read_partitioned(spark, path, *RANGE)
    return rounded(kept.select("user_id", "date", *MODEL_FEATURES))


def features_one_day(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "features")
    sinks.write_feature_days(user_day_features(txe(spark, folder)), path)
    return rounded(transactions.read_day(spark, path, QUIET_DAY).select("user_id", "date", *MODEL_FEATURES))


def features_quiet_day(spark: SparkSession, folder: str) -> DataFrame:
    """A range of days of which one has credits only."""
    raw, cleaned, features = (scratch_path(spark, label) for label in ("raw", "clean", "features"))
    tx = txe(spark, folder)
    quiet = F.to_date("transaction_date") == F.lit(QUIET_DAY).cast("date")
    kind = F.when(quiet, "CREDITO").otherwise(F.col("transaction_type"))
    sinks.write_snapshot(tx.withColumn("transaction_type", kind), raw)
    backfill.backfill(spark, raw, cleaned, features, scratch_path(spark, "model"), *RANGE, min_cnt=MIN_CNT)
    kept = transactions.read_partitioned(spark, features, *RANGE)
    return rounded(kept.select("user_id", "date", *MODEL_FEATURES))


def rolling(spark: SparkSession, folder: str, limit: HeatLimit = windows.ROLLING_HEAT) -> DataFrame:
    return rounded(windows.rolling_activity(txe(spark, folder), limit=limit))


def rolling_24h_large(spark: SparkSession, folder: str, limit: HeatLimit = windows.ROLLING_HEAT) -> DataFrame:
    """Some amounts of 1e16; windows without one have exact sums."""
    tx = txe(spark, folder)
    large = F.when(F.col("_id").cast("long") % 50 == 0, 1e16).otherwise(F.col("transaction_amount"))
    found = windows.rolling_activity(tx.withColumn("transaction_amount", large), limit=limit)
    return rounded(found.withColumn("sum_24h", F.when(F.col("sum_24h") < 1e15, F.col("sum_24h"))))


def anchor_features(spark: SparkSession, folder: str, limit: HeatLimit = DEFAULT_HEAT) -> DataFrame:
    return rounded(windows.anchor_features(txe(spark, folder), limit=limit))


def anchor_top_merchant(spark: SparkSession, folder: str) -> DataFrame:
    tx = txe(spark, folder)
    end = windows.resolve_end(tx)
    start = to_ntz(end) - F.expr("INTERVAL 30 DAYS")
    rows = windows.with_anchors(windows.history(tx, end), start, 30, 72)
    return windows.top_merchant(rows, ["user_id", "analysis_date"])


def z_scores(spark: SparkSession, folder: str) -> DataFrame:
    names = [f"z_{m}" for m in suspicion.WEIGHTS]
    return rounded(scores(spark, folder).select("user_id", *names))


def suspicion_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Without the scored window in its own history, one-anchor users on the global deviation."""
    found = detect.suspicion_report(txe(spark, folder), exclude_current=True, single_window="global")
    return rounded(found.select("user_id", "suspicion_score", "risk_level", "flag_suspicious"))


def suspicion_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scores(spark, folder).select("user_id", "suspicion_score", "risk_level", "flag_suspicious"))


def suspicion_alerts(spark: SparkSession, folder: str) -> DataFrame:
    found = suspicion.alerts(scores(spark, folder))
    return rounded(found.select("user_id", "suspicion_score", "risk_level", "investigation_priority"))


def forest_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(iforest.grow(active_features(spark, folder)).node_table(spark))


def trained(spark: SparkSession, folder: str, **options) -> tuple[iforest.ForestModel, DataFrame]:
    """A forest and the rows that it was trained on, scored."""
    active = active_features(spark, folder)
    return iforest.calibrate(iforest.grow(active, **options), active)


def forest_alerts(spark: SparkSession, folder: str) -> DataFrame:
    model, decided = trained(spark, folder)
    return alerts.flagged(decided, model.contamination)


def forest_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(forest_alerts(spark, folder))


def forest_scaled_scores(spark: SparkSession, folder: str) -> DataFrame:
    model, decided = trained(spark, folder, scale=True)
    return rounded(alerts.flagged(decided, model.contamination))


def forest_default_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Day thresholds of a stored model that names no contamination."""
    path = scratch_path(spark, "model")
    model, _ = trained(spark, folder)
    iforest.save(spark, dataclasses.replace(model, contamination=None), path)
    return rounded(alerts.alert_table(active_features(spark, folder), iforest.load(spark, path)))


def forest_day_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    _, decided = trained(spark, folder)
    return rounded(alerts.day_thresholds(decided, iforest.CONTAMINATION))


def forest_score_stats(spark: SparkSession, folder: str) -> DataFrame:
    _, decided = trained(spark, folder)
    return rounded(iforest.training_summary(decided))


def forest_flag_totals(spark: SparkSession, folder: str) -> DataFrame:
    return alerts.flag_totals(forest_alerts(spark, folder))


def forest_top10(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(alerts.lowest_scores(forest_alerts(spark, folder)))


def active_users(spark: SparkSession, folder: str) -> DataFrame:
    active = clean.active_only(day_features_o(spark, folder), MIN_CNT)
    return active.select("user_id").distinct().agg(F.count(F.lit(1)).alias("users"))


def backfilled_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw snapshot to clean days, feature days, model and alert file, over a range of days."""
    raw, cleaned, features, model, out = (
        scratch_path(spark, label) for label in ("raw", "clean", "features", "model", "alerts")
    )
    sinks.write_snapshot(txe(spark, folder), raw)
    backfill.backfill(spark, raw, cleaned, features, model, *RANGE, min_cnt=MIN_CNT)
    scored = backfill.score_days(spark, features, model, *RANGE, min_cnt=MIN_CNT, alerts_path=out)
    return rounded(spark.read.schema(scored.schema).option("header", True).csv(out))


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    return events_as_transactions(spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet"))


def stream_result(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    out, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    live.to_table(stream, out, state, finish=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def live_result(spark: SparkSession, stream: DataFrame, label: str, **options) -> DataFrame:
    """All windows of a stream that is read to its end, open ones from its state."""
    out, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    live.to_table(live.live_windows(stream, **options), out, state, finish=True).awaitTermination()
    return live.all_windows(spark, out, state)


def window_counts(found: DataFrame, *more: str) -> DataFrame:
    start = F.col("window.start").cast("timestamp_ntz").alias("window_start")
    return rounded(found.select("user_id", start, "cnt_24h", "sum_24h", *more))


def day_alerts(days: DataFrame) -> DataFrame:
    date = F.col("window.start").cast("timestamp_ntz").cast("date").alias("date")
    return live.threshold_alerts(days, {"Media": 3, "Alta": 5}).select("user_id", date, "cnt_24h", "alert")


def stream_24h_counts(spark: SparkSession, folder: str) -> DataFrame:
    return window_counts(live_result(spark, event_stream(spark, folder), "windows"))


def stream_24h_merchants(spark: SparkSession, folder: str) -> DataFrame:
    return window_counts(live_result(spark, event_stream(spark, folder), "windows"), "merchants")


def stream_24h_merchants_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Several micro-batches whose rows are dealt by hash: the watermark has to wait for the oldest."""
    events = events_as_transactions(in_batches(spark, folder, "events"))
    return window_counts(live_result(spark, events, "windows", watermark="3650 days"), "merchants")


def stream_day_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return day_alerts(live_result(spark, event_stream(spark, folder), "days", slide=None))


def stream_distinct_ids(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    stream = spark.readStream.schema(lines.schema).parquet(f"{folder}/lineitem*.parquet")
    rows = stream.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_id"),
        F.col("l_shipdate").alias("transaction_date"),
    )
    return stream_result(spark, live.without_repeats(rows, "1 hour").select("_id"), "ids")


def in_batches(spark: SparkSession, folder: str, table: str, files: int = 7) -> DataFrame:
    """A stream that reads a table as several micro-batches, its rows dealt by hash."""
    path = scratch_path(spark, f"{table}-files")
    rows = spark.read.parquet(f"{folder}/{table}.parquet")
    rows.repartition(files, F.xxhash64(*rows.columns)).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def stream_24h_counts_batches(spark: SparkSession, folder: str) -> DataFrame:
    events = events_as_transactions(in_batches(spark, folder, "events"))
    return window_counts(live.backlog_windows(events, scratch_path(spark, "windows-state")))


def stream_day_alerts_batches(spark: SparkSession, folder: str) -> DataFrame:
    events = events_as_transactions(in_batches(spark, folder, "events"))
    return day_alerts(live.backlog_windows(events, scratch_path(spark, "days-state"), slide=None))


def stream_distinct_ids_batches(spark: SparkSession, folder: str) -> DataFrame:
    ids = in_batches(spark, folder, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_id"))
    return stream_result(spark, live.without_repeats(ids).select("_id"), "ids")


def stream_model_alerts_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_model_alerts(spark, folder, events_as_transactions(in_batches(spark, folder, "events", 3)))


def stream_model_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_model_alerts(spark, folder, event_stream(spark, folder))


def _stream_model_alerts(spark: SparkSession, folder: str, events: DataFrame) -> DataFrame:
    """Alert days kept current by a stream, with a forest fitted on the finished days."""
    active = stored(clean.active_only(user_day_features(txe(spark, folder)), MIN_CNT), "active")
    model = iforest.fit(active)
    cleaned, out, state = (scratch_path(spark, label) for label in ("live", "live-alerts", "live-state"))
    live.score_into(events, cleaned, out, state, model, MIN_CNT, finish=True).awaitTermination()
    found = live.current_alerts(spark.read.parquet(out), model.contamination)
    return rounded(found.select(*alerts.ALERT_COLUMNS))


def build() -> dict[str, Query]:
    def on(source: Query, operator: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, folder: rounded(operator(source(spark, folder)))

    def ids(spark: SparkSession, folder: str) -> DataFrame:
        return with_mixed_ids(txr(spark, folder))

    def history(spark: SparkSession, folder: str) -> DataFrame:
        return windows.history(txe(spark, folder))

    def anchors(spark: SparkSession, folder: str) -> DataFrame:
        return windows.anchor_features(txe(spark, folder))

    return {
        "user_day_features": on(day_features_o, lambda f: f),
        "user_day_features_events": on(txe, user_day_features),
        "user_day_features_hot": on(txe, lambda tx: user_day_features(tx, ALL_HOT)),
        "user_day_features_holes": on(lambda s, d: with_holes(txe(s, d)), user_day_features),
        "source_union_counts": source_union_counts,
        "coerced_transactions": coerced_transactions,
        "coerced_formats": coerced_formats,
        "one_day_debits": one_day_debits,
        "calendar_parts": calendar_parts,
        "dedup_transactions": on(txo, lambda tx: tx),
        "dedup_within_day": on(lambda s, d: txo(s, d, within_day=True), lambda tx: tx),
        "duplicate_rows": on(txr, quality.duplicate_rows),
        "duplicate_ids": on(txr, quality.duplicate_ids),
        "duplicate_count": on(ids, quality.duplicate_count),
        "null_profile": null_profile,
        "columns_with_nulls": columns_with_nulls,
        "text_cardinality": text_cardinality,
        "type_frequency": on(txr, lambda tx: quality.value_frequency(tx, "transaction_type")),
        "nonpositive_amounts": on(
            lambda s, d: txr(s, d).withColumn("transaction_amount", F.col("transaction_amount") - 2000),
            quality.nonpositive_amounts,
        ),
        "date_range_check": on(txr, lambda tx: quality.date_range_check(tx, "1996-01-01", "2000-12-31")),
        "id_length_distribution": on(ids, quality.id_lengths),
        "id_format_check": on(ids, quality.id_format_check),
        "id_format_examples": on(ids, quality.id_format_examples),
        "amount_describe": amount_describe,
        "amount_quantiles": on(clean_o, amounts.amount_quantiles),
        "amount_bands": on(txe, amounts.amount_bands),
        "amount_bands_all": on(
            lambda s, d: txe(s, d).withColumn("transaction_amount", F.col("transaction_amount") * 10), amounts.amount_bands
        ),
        "activity_bands_all": on(spread_counts, activity.activity_bands),
        "activity_thresholds_all": on(spread_counts, activity.activity_thresholds),
        "sketched_cardinality": sketched_cardinality,
        "dedup_in_batches": dedup_in_batches,
        "flagged_alerts": flagged_alerts,
        "amount_histogram": on(clean_o, lambda tx: amounts.histogram(tx, "transaction_amount", 50)),
        "user_day_counts": counts_e,
        "user_day_summary": on(counts_e, activity.user_day_summary),
        "activity_bands": on(counts_e, activity.activity_bands),
        "activity_thresholds": on(counts_e, activity.activity_thresholds),
        "count_histograms": count_histograms,
        "recurrent_users": on(counts_e, activity.recurrent_users),
        "top_user_days": on(counts_o, lambda c: activity.top_user_days(c, MIN_CNT)),
        "consistent_users": on(counts_o, activity.consistent_users),
        "persistent_users": on(counts_o, lambda c: activity.persistent_users(c, MIN_CNT)),
        "persistent_first100": on(counts_o, lambda c: activity.persistent_users(c, MIN_CNT, first=100)),
        "normal_users": on(
            clean_o, lambda tx: activity.normal_users(tx, activity.user_day_counts(tx, sizes_from=tx), MIN_CNT)
        ),
        "normal_vs_active_cv": normal_vs_active_cv,
        "structuring_profile": on(profiles, lambda p: p),
        "structuring_rules": structuring_rules,
        "structuring_profile_hot": on(lambda s, d: profiles(s, d, limit=ALL_HOT), lambda p: p),
        "structuring_profile_first100": on(lambda s, d: profiles(s, d, first=100), lambda p: p),
        "structuring_top5": on(profiles, profile.top_suspects),
        "structuring_critical": on(profiles, lambda p: profile.critical_users(p, 0.05)),
        "indicator_shares": on(profiles, profile.indicator_shares),
        "indicator_medians": on(lambda s, d: stored(profiles(s, d)), profile.indicator_medians),
        "profile_histograms": profile_histograms,
        "merchant_histogram": on(
            lambda s, d: stored(profiles(s, d)), lambda p: amounts.unit_histogram(p, "comercios_unicos")
        ),
        "short_gap_profiles": on(profiles, lambda p: profile.short_gap_profiles(p, 300)),
        "profile_scatter": on(profiles, profile.profile_scatter),
        "sliding_24h_features": on(txe, windows.sliding_features),
        "daily_sliding_features": on(txe, windows.daily_sliding_features),
        "rolling_24h": rolling,
        "rolling_24h_hot": lambda s, d: rolling(s, d, ALL_HOT),
        "rolling_24h_large": rolling_24h_large,
        "rolling_24h_large_hot": lambda s, d: rolling_24h_large(s, d, ALL_HOT),
        "anchor_features": anchor_features,
        "anchor_features_hot": lambda s, d: anchor_features(s, d, ALL_HOT),
        "top_merchant": anchor_top_merchant,
        "user_baseline": on(anchors, baseline.user_baseline),
        "global_baseline": on(anchors, baseline.global_baseline),
        "fallback_baseline": on(history, baseline.fallback_baseline),
        "z_scores": z_scores,
        "suspicion_scores": suspicion_scores,
        "suspicion_repaired": suspicion_repaired,
        "risk_distribution": on(scores, suspicion.risk_distribution),
        "detection_rate": on(scores, suspicion.detection_rate),
        "suspicion_alerts": suspicion_alerts,
        "suspicion_top10": on(scores, suspicion.top_alerts),
        "z_importance": on(scores, suspicion.z_importance),
        "score_scatter": on(scores, suspicion.score_scatter),
        "score_histogram": on(
            lambda s, d: stored(scores(s, d)), lambda f: amounts.histogram(f, "suspicion_score", 30)
        ),
        "daily_coverage": daily_coverage,
        "features_in_range": features_in_range,
        "features_one_day": features_one_day,
        "features_quiet_day": features_quiet_day,
        "active_users": active_users,
        "forest_nodes": forest_nodes,
        "forest_scores": forest_scores,
        "forest_scaled_scores": forest_scaled_scores,
        "forest_default_contamination": forest_default_contamination,
        "forest_day_thresholds": forest_day_thresholds,
        "forest_score_stats": forest_score_stats,
        "forest_flag_totals": forest_flag_totals,
        "forest_top10": forest_top10,
        "backfilled_alerts": backfilled_alerts,
        "stream_24h_counts": stream_24h_counts,
        "stream_24h_merchants": stream_24h_merchants,
        "stream_24h_merchants_batches": stream_24h_merchants_batches,
        "stream_day_alerts": stream_day_alerts,
        "stream_distinct_ids": stream_distinct_ids,
        "stream_model_alerts": stream_model_alerts,
        "stream_24h_counts_batches": stream_24h_counts_batches,
        "stream_day_alerts_batches": stream_day_alerts_batches,
        "stream_distinct_ids_batches": stream_distinct_ids_batches,
        "stream_model_alerts_batches": stream_model_alerts_batches,
    }
