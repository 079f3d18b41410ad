import math
import random
import re

import pytest
from pyspark.sql import functions as F

from splitsight.operators import grouped, hotkeys, windows
from splitsight.operators.behaviour import user_day_features
from splitsight.operators.hotkeys import HeatLimit, hot_keys
from splitsight.operators.profile import structuring_profile
from splitsight.schema import MODEL_FEATURES
from splitsight.sources.adapters import order_transactions
from tests.conftest import DAY, SMALL, at

ALL_HOT = HeatLimit(0)


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize("limit", [HeatLimit(), ALL_HOT])
class TestUserDay:
    def test_single_debit(self, make, limit):
        r = only(user_day_features(make([("u", DAY, 7.0)]), limit))
        assert (r.cnt_24h, r.amount_std, r.amount_cv, r.amount_range) == (1, 0, 0, 0)
        assert (r.avg_interval_minutes, r.std_interval_minutes) == (0, 0)
        assert (r.merchant_concentration, r.subsidiary_concentration, r.same_amount_ratio) == (1, 1, 1)

    def test_minimal_pair(self, make, limit):
        r = only(user_day_features(make([("u", at(0), 5.0), ("u", at(1.5), 5.0)]), limit))
        assert (r.avg_interval_minutes, r.std_interval_minutes, r.same_amount_ratio) == (1.5, 0, 1)

    def test_gap_deviation(self, make, limit):
        r = only(user_day_features(make([("u", at(0), 1.0), ("u", at(4), 2.0), ("u", at(1), 3.0)]), limit))
        assert r.avg_interval_minutes == pytest.approx(2)
        assert r.std_interval_minutes == pytest.approx(math.sqrt(2))

    def test_zero_mean(self, make, limit):
        r = only(user_day_features(make([("u", at(0), 5.0), ("u", at(0), -5.0)]), limit))
        assert (r.amount_cv, r.avg_interval_minutes, r.amount_range) == (0, 0, 10)

    def test_null_amount_and_merchant(self, make, limit):
        tx = make([("u", at(0), None, None), ("u", at(1), 2.0, "a"), ("u", at(2), 2.0, "a")])
        r = only(user_day_features(tx, limit))
        assert (r.cnt_24h, r.unique_merchants) == (2, 1)
        assert r.same_amount_ratio == pytest.approx(2 / 3)
        assert r.merchant_concentration == pytest.approx(2 / 3)

    def test_all_amounts_null(self, make, limit):
        r = only(user_day_features(make([("u", at(0), None)]), limit))
        assert (r.cnt_24h, r.sum_24h, r.avg_amount) == (0, 0, 0)
        assert r.amount_range is None and r.same_amount_ratio is None

    def test_credits_and_undated_rows_give_nothing(self, make, limit):
        tx = make([("u", at(0), 1.0, "m", "CREDITO"), ("u", None, 1.0), (None, at(0), 1.0)])
        assert user_day_features(tx, limit).count() == 0


def test_hot_and_cold_groups_agree_when_mixed(spark, make):
    rng = random.Random(5)
    rows = []
    for user, n in (("big", 400), ("mid", 60), ("small", 7), ("one", 1)):
        for _ in range(n):
            amount = None if rng.random() < 0.05 else round(rng.choice([5.0, 10.0, rng.random() * 100]), 2)
            merchant = None if rng.random() < 0.1 else f"m{rng.randrange(5)}"
            rows.append((user, at(rng.randrange(0, 1440 * 60) / 60), amount, merchant))
    tx = make(rows)
    cold = user_day_features(tx).toPandas().sort_values("user_id").reset_index(drop=True)
    for limit in (HeatLimit(100), HeatLimit(10), ALL_HOT):
        mixed = user_day_features(tx, limit).toPandas().sort_values("user_id").reset_index(drop=True)
        for c in MODEL_FEATURES:
            assert list(mixed[c]) == pytest.approx(list(cold[c]), abs=1e-9), c


def test_hot_keys_are_found_exactly_and_by_sample(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id") % 5).alias("k"))
    assert hot_keys(df, ["k"]) is None
    assert [r.k for r in hot_keys(df, ["k"], HeatLimit(200)).collect()] == [7]
    many = spark.range(200_000).select(F.when(F.col("id") < 60_000, 7).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in hot_keys(many, ["k"], HeatLimit(40_000)).collect()] == [7]


def test_cold_features_use_one_exchange(make):
    plan = user_day_features(make([("u", DAY, 7.0)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_result_does_not_depend_on_partitioning(make):
    tx = make([(f"u{i % 3}", at(i * 7 % 100), float(i % 4)) for i in range(40)])
    a = user_day_features(tx).toPandas().sort_values("user_id").to_dict("list")
    b = user_day_features(tx.repartition(7)).toPandas().sort_values("user_id").to_dict("list")
    assert a == b


def test_trailing_window_is_closed_on_both_ends(make):
    tx = make([("u", at(0), 1.0), ("u", at(-1440), 2.0), ("u", at(-1440) - (at(1 / 6e7) - at(0)), 4.0)])
    assert only(windows.sliding_features(tx)).sum_24h == 3.0


def test_hours_are_counted_once(make):
    tx = make([("u", at(0), 1.0), ("u", at(59), 1.0), ("u", at(60), 1.0)])
    assert only(windows.sliding_features(tx)).hour_dispersion == 2


def brute_anchors(times, start, lookback, step, window, first):
    import datetime as dt

    pairs = []
    for i in range(first, int(lookback * 24 / step) + 1):
        anchor = start + dt.timedelta(hours=i * step)
        pairs += [(t, anchor) for t in times if anchor - dt.timedelta(hours=window) <= t <= anchor]
    return sorted(pairs)


@pytest.mark.parametrize("step,window,first", [(72, 24, 0), (24, 24, 1), (12, 48, 0), (24, 23, 0)])
def test_anchors_equal_the_range_join(make, step, window, first):
    import datetime as dt

    rng = random.Random(step + window)
    times = [DAY + dt.timedelta(hours=h) for h in range(0, 240, 12)]
    times += [DAY + dt.timedelta(seconds=rng.randrange(0, 10 * 86400)) for _ in range(80)]
    tx = make([("u", t, 1.0) for t in times])
    got = windows.with_anchors(tx, F.lit(DAY.isoformat()).cast("timestamp_ntz"), 10, step, window, first)
    pairs = sorted((r.transaction_date, r.analysis_date) for r in got.collect())
    assert pairs == brute_anchors(times, DAY, 10, step, window, first)


@pytest.mark.parametrize("limit", [HeatLimit(), ALL_HOT])
def test_rolling_sums_forget_large_amounts(make, limit):
    tx = make([("u", at(0), 1e16), ("u", at(60), 1.0), ("u", at(24.5 * 60), 1.0)])
    got = [r.sum_24h for r in sorted(windows.rolling_activity(tx, limit=limit).collect(), key=lambda r: r.transaction_date)]
    assert got[0] == 1e16 and got[2] == 2.0


@pytest.mark.parametrize("limit", [HeatLimit(), ALL_HOT])
def test_time_differences_ignore_the_session_zone(spark, make, limit):
    import datetime as dt

    change = dt.datetime(2021, 3, 14)
    tx = make([("u", at(150, change), 1.0), ("u", at(190, change), 2.0)])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert only(user_day_features(tx, limit)).avg_interval_minutes == 40
        rolled = windows.rolling_activity(tx, 0.5, limit).collect()
        assert sorted(r.cnt_24h for r in rolled) == [1, 1]
        anchored = windows.anchor_features(tx, at(190, change), 1, 1, limit=limit).collect()
        assert [r.analysis_date for r in anchored] == [at(190, change)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("limit", [HeatLimit(), ALL_HOT])
def test_rolling_activity_equals_brute_force(make, limit):
    import datetime as dt

    rng = random.Random(1)
    times = [DAY + dt.timedelta(seconds=rng.randrange(0, 4 * 86400)) for _ in range(150)]
    times += [times[0] + dt.timedelta(hours=24), times[0], times[1] + dt.timedelta(hours=24, microseconds=1)]
    rows = [("u", t, float(rng.randrange(1, 50)), rng.choice(["a", "b", "c", None])) for t in times]
    found = windows.rolling_activity(make(rows), limit=limit).collect()
    assert len(found) == len(rows)
    got = {r.transaction_date: (r.cnt_24h, r.sum_24h, r.unique_merchants) for r in found}
    for t in set(times):
        inside = [(a, m) for _, x, a, m in rows if t - dt.timedelta(hours=24) <= x <= t]
        assert got[t] == (len(inside), pytest.approx(sum(a for a, _ in inside)), len({m for _, m in inside} - {None}))


def test_top_merchant_prefers_the_smaller_on_ties(make):
    tx = make([("u", at(0), 1.0, "b"), ("u", at(1), 1.0, "a"), ("u", at(2), 1.0, None), ("u", at(3), 1.0, None)])
    assert only(windows.top_merchant(tx, ["user_id"])).top_merchant == "a"


def test_gaps_of_hot_groups_are_stored(make):
    """No union is left in them, which an adaptive plan of several joins can't zip with its other branches."""
    tx = make([("u", at(m), 1.0) for m in (0, 0, 0.5, 3)] + [("v", at(0), 1.0), ("v", None, 1.0)])
    gaps = grouped.hot_gaps(tx, ["user_id"])
    assert "Union" not in gaps._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, gaps.collect())) == [("u", 0.0, 1), ("u", 0.5, 1), ("u", 2.5, 1)]


def test_tasks_follow_the_rows(make, monkeypatch):
    """More rows are more tasks, not larger ones; results stay."""
    tx = make([(f"u{u}", at(7 * n), float(n), f"m{n % 3}") for u in range(50) for n in range(8)])
    users, limit = tx.select("user_id").distinct(), HeatLimit(500)

    def told():
        found = user_day_features(tx, limit), structuring_profile(tx, users, limit)
        return [f.rdd.getNumPartitions() for f in found], [sorted(map(str, f.collect())) for f in found]

    few, whole = told()
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 40)
    many, same = told()
    assert few == [2, 2] and many == [10, 10] and same == whole


def test_join_with_users_is_dealt(spark, make, monkeypatch):
    """Its tasks follow the rows, not the session's shuffle partitions, in a join that isn't broadcast."""
    tx = make([(f"u{u}", at(7 * n), float(n), f"m{n % 3}") for u in range(50) for n in range(8)])
    users = tx.where("user_id < 'u3'").select("user_id").distinct()
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 40)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = structuring_profile(tx, users, HeatLimit(500))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"hashpartitioning\(user_id#\d+, (\d+)\)", plan).count("5") == 2
        assert {r.user_id for r in found.collect()} == {r.user_id for r in users.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_order_lines_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 500)
    whole = order_transactions(spark, SMALL)
    sizes = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1000
    assert sum(sizes) == spark.read.parquet(f"{SMALL}/lineitem.parquet").join(spark.read.parquet(f"{SMALL}/orders.parquet"), F.expr("l_orderkey = o_orderkey")).count()
