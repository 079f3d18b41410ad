import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from splitsight.operators import activity, amounts, hotkeys, profile
from splitsight.operators.hotkeys import HeatLimit
from splitsight.operators import quantiles
from splitsight.operators.quantiles import exact_quantiles
from splitsight.plans.explore import persistent_profile
from tests.conftest import at

PROBS = {"p0": 0.0, "p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p1": 1.0}


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=501), "b": np.repeat([1.0, 2.0], [300, 1]), "c": np.array([4.0]), "d": rng.integers(0, 5, 200) * 1.0}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None)], "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, "v", PROBS, by=["g"]).collect()}
    for g, vs in groups.items():
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.percentile(vs, 100 * p), abs=1e-12)
    everything = np.concatenate(list(groups.values()))
    row = exact_quantiles(df, "v", PROBS).first()
    assert [row[n] for n in PROBS] == pytest.approx([np.percentile(everything, 100 * p) for p in PROBS.values()])


@pytest.mark.parametrize("most", [1, 3, 40])
def test_buckets_are_narrowed_down_to_a_bound(spark, monkeypatch, most):
    """Rounds go on until no ordered bucket has more values than the bound; results stay exact."""
    rng = np.random.default_rng(most)
    values = np.concatenate([rng.normal(size=3000), np.full(500, 0.25), rng.exponential(1e6, 300)]).round(4)
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)], "g int, v double")
    ordered = []
    interpolated = quantiles._interpolated
    monkeypatch.setattr(quantiles, "BUCKETS", 4)
    monkeypatch.setattr(quantiles, "_interpolated", lambda rows, by, probs: ordered.append(rows) or interpolated(rows, by, probs))
    for by, parts in (([], {None: values}), (["g"], {g: values[g::2] for g in (0, 1)})):
        for row in exact_quantiles(df, "v", PROBS, by=by, most=most).collect():
            part = parts[row["g"] if by else None]
            assert [row[n] for n in PROBS] == pytest.approx([np.quantile(part, q) for q in PROBS.values()], rel=1e-12)
        assert max(r["count"] for r in ordered[-1].groupBy(*by, "_bucket").count().collect()) <= most


def test_weighted_quantiles_and_empty_input(spark):
    df = spark.createDataFrame([(1.0, 3), (5.0, 1)], "v double, w long")
    assert exact_quantiles(df, "v", {"m": 0.5, "h": 1.0}, weight="w").first().asDict() == {"m": 1.0, "h": 5.0}
    assert exact_quantiles(df.where("v > 9"), "v", {"m": 0.5}).first().m is None


@pytest.mark.parametrize("values,bins", [([1, 2, 2, 3, 10], 3), ([4, 4, 4], 5), (list(range(1, 21)), 19), ([0.1, 0.2, 0.3, 0.7], 6)])
def test_histogram_equals_numpy(spark, values, bins):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    rows = amounts.histogram(df, "v", bins).orderBy("bin").collect()
    expected, edges = np.histogram(values, bins=bins)
    assert [r.n for r in rows] == list(expected)
    assert [r.bin_lo for r in rows] == pytest.approx(list(edges[:-1]))


def test_bands_add_up(spark):
    df = spark.createDataFrame([(f"u{n}", "2021-01-01", n) for n in (1, 1, 2, 5, 6, 10, 11, 20, 21, 50, 51, 100, 101)], "user_id string, date string, cnt_24h long")
    got = {r.band: r.cases for r in activity.activity_bands(df).collect()}
    assert got == {"1": 2, "2-5": 2, "6-10": 2, "11-20": 2, "21-50": 2, "51-100": 2, ">100": 1}
    row = activity.activity_thresholds(df).first()
    assert row.one + row.over_1 == row.cases == sum(got.values())
    assert row.from_2_to_5 + row.from_6_to_10 + row.over_10 == row.over_1


def test_amount_bands_are_right_closed(make):
    tx = make([("u", at(0), v) for v in (100.0, 100.01, 500.0, 500.01, None)])
    got = {r.band: (r.transactions, r.pct) for r in amounts.amount_bands(tx).collect()}
    assert got == {"<=100": (1, 20.0), "100-500": (2, 40.0), ">500": (1, 20.0)}


def profile_of(spark, make, rows, limit=HeatLimit()):
    tx = make(rows)
    users = tx.select("user_id").distinct()
    return {r.user_id: r for r in profile.structuring_profile(tx, users, limit).collect()}


@pytest.mark.parametrize("limit", [HeatLimit(), HeatLimit(0)])
def test_profile_rules(spark, make, limit):
    rows = [("four", at(i), 10.0) for i in range(4)]
    rows += [("five", at(i), 10.0) for i in range(5)]
    rows += [("twenty", at(i * 300), 7.0) for i in range(20)]
    rows += [("more", at(i * 300), 7.0) for i in range(21)]
    rows += [("spread", at(i * 301), v) for i, v in enumerate([5.0, 15.0, 20.0, 33.0, 60.0, 100.0])]
    got = profile_of(spark, make, rows, limit)
    assert "four" not in got
    assert got["five"].concentracion_montos == 1.0
    assert got["five"].score_fraccionamiento == pytest.approx(0.9)
    assert got["more"].score_fraccionamiento - got["twenty"].score_fraccionamiento == pytest.approx(0.1)
    spread = got["spread"]
    counts, _ = np.histogram([5, 15, 20, 33, 60, 100], bins=3)
    assert spread.concentracion_montos == pytest.approx(counts.max() / 6)
    assert spread.pct_montos_terminan_5 == pytest.approx(2 / 6)
    assert spread.pct_montos_exactos == pytest.approx(3 / 6)
    assert spread.mediana_intervalo_min == 301
    assert all(0 <= r.score_fraccionamiento <= 1 for r in got.values())


def test_persistent_and_normal_users(make):
    rows = []
    for day in range(3):
        rows += [("busy", at(day * 1440 + i), 1.0 + i) for i in range(11)]
    rows += [("calm", at(i * 1000), 2.0 + i) for i in range(5)] + [("rare", at(0), 1.0)]
    tx = make(rows)
    counts = activity.user_day_counts(tx)
    assert [(r.user_id, r.high_days) for r in activity.persistent_users(counts).collect()] == [("busy", 3)]
    assert [r.user_id for r in activity.normal_users(tx, counts).collect()] == ["calm"]
    assert [r.user_id for r in persistent_profile(tx).collect()] == ["busy"]
    assert activity.top_user_days(counts, 10).count() == 3


def test_large_counts_are_dealt_by_rows(make, monkeypatch):
    """More rows than the session's shuffle partitions should count are more tasks; counts stay, of hot users and without NULLs."""
    rows = [(f"u{n % 40}", at(500 * (n // 40) + n), 1.0) for n in range(400)] + [("hot", at(n), 1.0) for n in range(90)]
    tx = make([*rows, ("u1", None, 1.0), *[(None, at(n), 1.0) for n in range(20)]])
    plain = sorted(map(str, activity.user_day_counts(tx).collect()))
    few = sorted(map(str, activity.user_day_counts(tx, sizes_from=tx).collect()))
    users = sorted(map(str, activity.persistent_users(activity.user_day_counts(tx), 1).collect()))
    profiled = sorted(map(str, persistent_profile(tx, 1).collect()))
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 10)

    def told(limit):
        counts = activity.user_day_counts(tx, sizes_from=tx, limit=limit)
        persistent = activity.persistent_users(counts, 1)
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in (counts, persistent)]
        assert counts.columns == ["user_id", "date", "cnt_24h"]
        assert plain == few == sorted(map(str, counts.collect()))
        assert users == sorted(map(str, persistent.collect()))
        return plans

    # Users who aren't hot are counted, and their days too, where they were dealt.
    for plan in told(HeatLimit(500)):
        assert re.findall(r"hashpartitioning\((.+), (\d+)\)", plan) == [(re.search(r"user_id#\d+", plan)[0], "13")]
    # Rows of a hot user are combined before their exchange.
    counts, _ = told(HeatLimit(50))
    assert re.findall(r"hashpartitioning\(user_id#\d+, date#\d+, (\d+)\)", counts) == ["4"] and counts.count("partial_count") == 2
    assert users and profiled == sorted(map(str, persistent_profile(tx, 1).collect()))


def test_large_profile_counts_by_rows(make, monkeypatch):
    """The stored table of a profile is large enough to be dealt, though the session has few shuffle partitions."""
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 10)
    tx = make([(f"u{n % 40}", at(500 * (n // 40) + n), 1.0) for n in range(400)])
    plan = persistent_profile(tx, 1)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(user_id#\d+, date#\d+, \d+\)", plan)
    assert not re.search(r"hashpartitioning\(user_id#\d+, 4\)", plan)


def test_day_spine(spark):
    df = spark.range(1)
    assert activity.day_spine("2021-02-27", "2021-03-01", df).count() == 3
    with pytest.raises(ValueError):
        activity.day_spine("2021-02-02", "2021-02-01", df)


def test_unit_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(1,), (4,)], "v int")
    assert [(r.bin, r.n) for r in amounts.unit_histogram(df, "v").orderBy("bin").collect()] == [(1, 1), (2, 0), (3, 0), (4, 1)]
    assert amounts.unit_histogram(df.where(F.col("v") > 9), "v").count() == 0
