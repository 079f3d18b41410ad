import datetime as dt

import pytest

from splitsight.operators import baseline, suspicion, windows
from splitsight.plans.detect import suspicion_report
from splitsight.schema import BASELINE_METRICS
from tests.conftest import DAY, at


def scored(spark, score_parts):
    """Scores for given z of the count, the only non-zero metric."""
    z = {m: 0.0 for m in suspicion.WEIGHTS}
    rows = [(f"u{i}", cnt, *[{**z, **parts}[m] for m in z]) for i, (cnt, parts) in enumerate(score_parts)]
    names = ["user_id string", "cnt_24h long", *[f"z_{m} double" for m in z]]
    return suspicion.suspicion_scores(spark.createDataFrame(rows, ", ".join(names)))


@pytest.mark.parametrize(
    "score,level,flag,priority",
    [
        (1.0, "Bajo", False, None),
        (2.5, "Medio", False, None),
        (4.0, "Alto", True, "Media"),
        (4.0001, "Crítico", True, "Media"),
        (5.0, "Crítico", True, "Media"),
        (8.0, "Crítico", True, "Alta"),
        (8.5, "Crítico", True, "Crítica"),
    ],
)
def test_band_edges(spark, score, level, flag, priority):
    scores = scored(spark, [(9, {"sum_24h": score})])
    row = scores.first()
    assert (row.suspicion_score, row.risk_level, row.flag_suspicious) == (score, level, flag)
    found = suspicion.alerts(scores).collect()
    assert [r.investigation_priority for r in found] == ([priority] if flag else [])


def test_halving_and_interval_term(spark):
    parts = [(3, {"sum_24h": 2.0}), (4, {"sum_24h": 2.0}), (9, {"avg_interval_minutes": -2.0}), (9, {"avg_interval_minutes": 2.0})]
    got = [r.suspicion_score for r in scored(spark, parts).orderBy("user_id").collect()]
    assert got == [1.0, 2.0, 3.0, 1.5]


def test_null_score_never_alerts(spark):
    scores = scored(spark, [(9, {"sum_24h": None})])
    row = scores.first()
    assert (row.suspicion_score, row.risk_level, row.flag_suspicious) == (None, None, False)
    assert suspicion.risk_distribution(scores).count() == 0


def history(days, per_day=2, user="u", amount=10.0):
    rows = []
    for d in days:
        base = DAY + dt.timedelta(days=d)
        rows += [(user, base - dt.timedelta(minutes=10 * i), amount + i) for i in range(per_day)]
    return rows


def test_user_with_one_anchor_has_no_score_unless_repaired(make):
    rows = history([0], per_day=4) + history([-3, -6, 0], per_day=3, user="v")
    tx = make(rows)
    plain = {r.user_id: r for r in suspicion_report(tx).collect()}
    assert plain["u"].suspicion_score is None and not plain["u"].flag_suspicious
    assert plain["v"].suspicion_score is not None
    repaired = {r.user_id: r for r in suspicion_report(tx, single_window="global").collect()}
    assert repaired["u"].suspicion_score is not None
    assert repaired["v"].suspicion_score == pytest.approx(plain["v"].suspicion_score)


def test_equal_anchors_divide_by_one(make):
    tx = make(history([0, -3, -6, -9], per_day=3))
    row = suspicion_report(tx).first()
    # The end itself is not part of the history, so the last anchor holds one debit less.
    assert row.z_cnt_24h == pytest.approx((3 - 2.75) / 0.5)
    assert row.z_hour_dispersion == row.hour_dispersion


def test_user_only_at_the_end_uses_the_global_row(make):
    tx = make([("late", DAY, 5.0)] + history([-3, -6], user="v") + history([0], user="w"))
    anchors = windows.anchor_features(tx)
    assert {r.user_id for r in baseline.user_baseline(anchors).collect()} == {"v", "w"}
    overall = baseline.global_baseline(anchors).first()
    row = [r for r in suspicion_report(tx).collect() if r.user_id == "late"][0]
    assert row.z_sum_24h == pytest.approx((5.0 - overall.sum_24h_mean) / overall.sum_24h_std)


def test_fallback_serves_everyone_when_no_anchor_holds_a_row(make, spark):
    tx = make([("u", at(-1440 * 2), 4.0), ("u", at(-1440 * 2), 6.0), ("v", at(-1440 * 2), 8.0), ("v", DAY, 1.0)])
    anchors = windows.anchor_features(tx)
    assert anchors.count() == 0
    features = windows.sliding_features(tx)
    row = baseline.with_baseline(features, anchors, windows.history(tx)).first()
    assert (row.cnt_24h_mean, row.sum_24h_mean, row.avg_amount_mean) == (1.5, 9.0, 6.5)
    assert (row.unique_merchants_mean, row.unique_merchants_std) == (0.0, 1.0)
    bare = baseline.with_baseline(features, anchors).first()
    assert [bare[f"{m}_std"] for m in BASELINE_METRICS] == [1.0] * len(BASELINE_METRICS)


def test_given_end_reaches_the_scan(spark, make, tmp_path):
    make(history([0, -1, -40])).write.parquet(str(tmp_path / "tx"))
    tx = spark.read.parquet(str(tmp_path / "tx"))
    plan = windows.trailing_window(tx, DAY)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(transaction_date,2021-02-14T00:00)" in pushed and "LessThanOrEq" in pushed
