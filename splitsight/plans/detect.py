"""Statistical detection end to end."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from splitsight.operators import baseline, suspicion, windows
from splitsight.operators.hotkeys import DEFAULT_HEAT, HeatLimit
from splitsight.session import stored


def suspicion_report(
    tx: DataFrame,
    end_ts: str | datetime | None = None,
    lookback_days: int = 30,
    step_days: float = 3,
    window_hours: float = 24,
    weights: dict[str, float] = suspicion.WEIGHTS,
    threshold: float = suspicion.ALERT_THRESHOLD,
    exclude_current: bool = False,
    single_window: str = "null",
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """Scores of all users with debits in the trailing window.

    The anchor features, one row per user and anchor, are stored once: the baseline of each user
    and the one over everyone both read them.
    """
    end_ts = windows.resolve_end(tx, end_ts)
    features = windows.sliding_features(tx, end_ts, window_hours, limit)
    anchors = stored(
        windows.anchor_features(tx, end_ts, lookback_days, step_days, window_hours, exclude_current, limit),
        "anchors",
    )
    history = windows.history(tx, end_ts, lookback_days)
    based = baseline.with_baseline(features, anchors, history, single_window)
    return suspicion.suspicion_scores(suspicion.z_scores(based, weights), weights, threshold)
