import datetime as dt
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from splitsight.operators import alerts, clean, iforest
from splitsight.operators.behaviour import user_day_features
from splitsight.plans import backfill
from splitsight.sources import sinks, transactions
from splitsight.streaming import live
from tests.conftest import DAY, at


@pytest.fixture(scope="module")
def busy(make):
    rng = random.Random(2)
    rows = [
        (f"u{u}", at(d * 1440 + rng.random() * 1400), round(rng.random() * 100, 2), f"m{rng.randrange(4)}")
        for u in range(6)
        for d in range(3)
        for _ in range(rng.randrange(3, 16))
    ]
    return make(rows)


@pytest.fixture()
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in ("raw", "clean", "features", "model", "alerts", "state")}


def test_backfill_then_score(spark, busy, paths):
    sinks.write_snapshot(busy.unionByName(busy.limit(5)), paths["raw"])
    days = ("2021-02-15", "2021-02-17")
    model = backfill.backfill(
        spark, paths["raw"], paths["clean"], paths["features"], paths["model"], *days, min_cnt=5, n_trees=20
    )
    assert transactions.read_partitioned(spark, paths["clean"], *days).count() == busy.count()
    scored = backfill.score_days(spark, paths["features"], paths["model"], *days, min_cnt=5, alerts_path=paths["alerts"])
    expected = alerts.alert_table(clean.active_only(user_day_features(busy), 5), model)
    assert sorted(map(str, scored.collect())) == sorted(map(str, expected.collect()))
    assert spark.read.option("header", True).csv(paths["alerts"]).columns == alerts.ALERT_COLUMNS
    one = backfill.score_days(spark, paths["features"], paths["model"], "2021-02-16", min_cnt=5)
    assert {r.date for r in one.collect()} == {dt.date(2021, 2, 16)}
    assert backfill.score_days(spark, paths["features"], paths["model"], "2021-03-01").count() == 0


def test_rerun_replaces_only_its_day(spark, make, paths):
    sinks.write_clean_days(make([("u", at(0), 1.0), ("u", at(1440), 2.0)]), paths["clean"])
    sinks.write_clean_days(make([("u", at(5), 9.0)]), paths["clean"])
    stored = transactions.read_partitioned(spark, paths["clean"], "2021-02-01", "2021-02-28")
    assert sorted(r.transaction_amount for r in stored.collect()) == [2.0, 9.0]


def test_days_are_padded_on_disk_and_pruned_on_read(spark, make, paths, tmp_path):
    sinks.write_clean_days(make([("u", dt.datetime(2021, 2, 5), 1.0)]), paths["clean"])
    assert (tmp_path / "clean/year=2021/month=02/day=05").is_dir()
    plan = transactions.read_day(spark, paths["clean"], "2021-02-05")._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_days_equal_the_union_of_single_days(busy):
    whole = sorted(map(str, user_day_features(busy).collect()))
    single = []
    for d in range(3):
        day = (DAY + dt.timedelta(days=d)).date().isoformat()
        single += map(str, user_day_features(clean.on_day(busy, day)).collect())
    assert sorted(single) == whole


def test_ranges_are_checked(spark, paths):
    with pytest.raises(ValueError):
        backfill.check_range("2021-02-02", "2021-02-01")
    with pytest.raises(ValueError):
        transactions.read_partitioned(spark, paths["clean"], "2021-02-02", "2021-02-01")


def stream_of(spark, df, path):
    df.coalesce(1).write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def whole_days(tx):
    rows = user_day_features(tx).select("user_id", "date", "cnt_24h", F.round("sum_24h", 6), "unique_merchants")
    return sorted(map(tuple, rows.collect()))


def told_days(found):
    return sorted(map(tuple, found.select("user_id", F.to_date("window.start"), "cnt_24h", F.round("sum_24h", 6), "merchants").collect()))


def test_live_windows_equal_the_batch(spark, busy, paths):
    stream = stream_of(spark, busy, paths["raw"])
    days = live.live_windows(stream, slide=None)
    live.to_table(days, paths["alerts"], paths["state"], finish=True).awaitTermination()
    closed = spark.read.schema(days.schema).parquet(paths["alerts"])
    assert told_days(closed) == [r for r in whole_days(busy) if r[1] < dt.date(2021, 2, 17)]
    assert told_days(live.all_windows(spark, paths["alerts"], paths["state"])) == whole_days(busy)


def test_open_windows_are_told_before_and_after_a_restart(spark, busy, paths):
    """Reading the state changes nothing in it: a query that goes on writes each window once."""
    for day in range(3):
        busy.where(F.to_date("transaction_date") == F.lit(DAY + dt.timedelta(days=day)).cast("date")).coalesce(1).write.mode("append").parquet(paths["raw"])
        stream = spark.readStream.schema(busy.schema).parquet(paths["raw"])
        live.to_table(live.live_windows(stream, slide=None), paths["alerts"], paths["state"], finish=True).awaitTermination()
        so_far = [r for r in whole_days(busy) if r[1] <= (DAY + dt.timedelta(days=day)).date()]
        assert told_days(live.all_windows(spark, paths["alerts"], paths["state"])) == so_far


def test_a_backlog_is_counted_whole_in_any_order(spark, busy, paths):
    rows = busy.repartition(6, "_id")
    rows.write.parquet(paths["raw"])
    stream = spark.readStream.schema(busy.schema).option("maxFilesPerTrigger", 1).parquet(paths["raw"])
    assert told_days(live.backlog_windows(stream, paths["state"], slide=None)) == whole_days(busy)


def told_windows(found):
    rows = found.select("user_id", "window.start", "window.end", "cnt_24h", F.round("sum_24h", 6), "merchants").collect()
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("slide", ["1 hour", "5 hours"])
def test_sliding_windows_share_rows_of_the_state(spark, busy, paths, tmp_path, slide):
    """Blocks of windows give the windows of a plain aggregation, from few state rows per transaction."""
    holes = F.when(F.col("transaction_amount") > 20, F.col("transaction_amount"))
    merchants = F.when(F.col("transaction_amount") < 90, F.col("merchant_id"))
    tx = busy.withColumns({"transaction_amount": holes, "merchant_id": merchants})
    span = F.window(F.col("transaction_date").cast("timestamp"), "24 hours", slide)
    expected = clean.debits(tx).groupBy(span, "user_id").agg(
        F.count("transaction_amount").alias("cnt_24h"),
        F.coalesce(F.sum("transaction_amount"), F.lit(0.0)).alias("sum_24h"),
        F.count_distinct("merchant_id").alias("merchants"),
    )
    stream = stream_of(spark, tx, paths["raw"])
    assert told_windows(live.backlog_windows(stream, paths["state"], slide=slide)) == told_windows(expected)
    held = spark.read.format("statestore").load(paths["state"]).count()
    assert held <= (4 if slide == "1 hour" else 2) * tx.count()
    out, state = str(tmp_path / "live"), str(tmp_path / "live-state")
    live.to_table(live.live_windows(stream, slide=slide), out, state, finish=True).awaitTermination()
    assert 0 < spark.read.parquet(out).count() < expected.count()
    assert told_windows(live.all_windows(spark, out, state, slide=slide)) == told_windows(expected)


def test_late_rows_are_counted(spark, make, paths):
    """A late row goes once the watermark of the batch before its own has passed its window."""
    for n, day in enumerate((20, 21, 0, 22)):
        make([("u", at(day * 1440), 1.0, "m", "DEBITO", f"id{n}")]).coalesce(1).write.mode("append").parquet(paths["raw"])
        time.sleep(1.1)  # files are read in the order of their times
    stream = spark.readStream.schema(make([("u", at(0), 1.0)]).schema).option("maxFilesPerTrigger", 1).parquet(paths["raw"])
    late = live.LateRows(spark)
    query = live.to_table(live.live_windows(stream, slide=None), paths["alerts"], paths["state"], finish=True)
    query.awaitTermination()
    assert late.of(query) == 1
    late.close()
    days = [r[1] for r in told_days(live.all_windows(spark, paths["alerts"], paths["state"]))]
    assert days == [(DAY + dt.timedelta(days=d)).date() for d in (20, 21, 22)]


def test_state_is_on_disk_and_settings_come_back(spark, make, paths):
    tx = make([("u", at(i), 1.0, "m", "DEBITO", f"id{i % 5}") for i in range(20)])
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    query = live.to_table(live.without_repeats(stream_of(spark, tx, paths["raw"])).select("_id"), paths["alerts"], paths["state"], finish=True)
    query.awaitTermination()
    assert spark.read.parquet(paths["alerts"]).count() == 5
    metrics = query.lastProgress.stateOperators[0].customMetrics
    assert any(name.startswith("rocksdb") for name in metrics)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_threshold_labels(spark):
    df = spark.createDataFrame([(10,), (11,), (51,)], "cnt_24h long")
    assert [(r.cnt_24h, r.alert) for r in live.threshold_alerts(df).orderBy("cnt_24h").collect()] == [(11, "Media"), (51, "Alta")]


def test_stream_drops_repeated_ids(spark, make, paths):
    tx = make([("u", at(0), 1.0, "m", "DEBITO", "a"), ("u", at(1), 1.0, "m", "DEBITO", "a"), ("u", at(2), 1.0, "m", "DEBITO", "b")])
    rows = live.without_repeats(stream_of(spark, tx, paths["raw"])).select("_id")
    live.to_table(rows, paths["alerts"], paths["state"], finish=True).awaitTermination()
    assert sorted(r._id for r in spark.read.parquet(paths["alerts"]).collect()) == ["a", "b"]


def test_only_folders_of_the_range_are_listed(spark, make, paths, tmp_path):
    tx = make([("u", dt.datetime(2021, m, d), float(d)) for m in (1, 2, 3) for d in range(1, 29)])
    sinks.write_clean_days(tx, paths["clean"])
    found = transactions.read_partitioned(spark, paths["clean"], "2021-02-27", "2021-03-02")
    assert sorted(r.transaction_amount for r in found.collect()) == [1.0, 2.0, 27.0, 28.0]
    assert "InMemoryFileIndex(4 paths)" in found._jdf.queryExecution().executedPlan().toString()
    # Folders that no listing may open: unreadable as a table, outside the range.
    (tmp_path / "clean/year=2020/month=01/day=01").mkdir(parents=True)
    (tmp_path / "clean/year=2020/month=01/day=01/part-0.parquet").write_text("broken")
    given = transactions.read_partitioned(spark, paths["clean"], "2021-02-28", "2021-03-01", tx.schema)
    assert sorted(r.transaction_amount for r in given.collect()) == [1.0, 28.0] and "year" in given.columns
    assert transactions.read_day(spark, paths["clean"], "2021-02-28", tx.schema).count() == 1
    assert transactions.read_day(spark, paths["clean"], "2022-01-01", tx.schema).count() == 0


@pytest.fixture()
def scored_stream(spark, busy, paths):
    """A function that starts the scoring of three micro-batches, and the alerts that have to follow."""
    active = clean.active_only(user_day_features(busy), 5)
    model = iforest.fit(active, n_trees=20)
    busy.repartition(3, "_id").write.parquet(paths["raw"])
    stream = spark.readStream.schema(busy.schema).option("maxFilesPerTrigger", 1).parquet(paths["raw"])

    def run():
        live.score_into(stream, paths["clean"], paths["alerts"], paths["state"], model, 5, finish=True).awaitTermination()
        found = live.current_alerts(spark.read.parquet(paths["alerts"]), model.contamination)
        return sorted(map(str, found.select(*alerts.ALERT_COLUMNS).collect()))

    return run, sorted(map(str, alerts.alert_table(active, model).collect()))


def test_stream_scoring_equals_the_batch(scored_stream):
    run, expected = scored_stream
    assert run() == expected


@pytest.mark.parametrize("failing", ["clean", "alerts"])
def test_a_write_that_fails_halfway_loses_nothing(spark, scored_stream, paths, monkeypatch, failing):
    run, expected = scored_stream
    write = sinks.write_batch

    def broken(df, path, date_column, number):
        if number == 1 and path == paths[failing]:
            write(df.limit(7), path, date_column, number)
            raise OSError("lost in the middle of a write")
        write(df, path, date_column, number)

    monkeypatch.setattr(sinks, "write_batch", broken)
    with pytest.raises(StreamingQueryException):
        run()
    # What the first batch wrote is still there, whole; which file came first is not fixed.
    sizes = {r["count"] for r in spark.read.parquet(paths["raw"]).groupBy(F.input_file_name()).count().collect()}
    assert spark.read.parquet(paths["clean"]).where("batch = 0").count() in sizes
    monkeypatch.setattr(sinks, "write_batch", write)
    assert run() == expected
