"""From transactions to the profile of persistently active users."""

from __future__ import annotations

from pyspark.sql import DataFrame

from splitsight.operators import activity
from splitsight.operators.hotkeys import DEFAULT_HEAT, HeatLimit
from splitsight.operators.profile import structuring_profile


def persistent_profile(
    tx: DataFrame,
    min_cnt: int = 10,
    min_days: int = 3,
    first: int | None = None,
    limit: HeatLimit = DEFAULT_HEAT,
) -> DataFrame:
    """Profile of all persistent users, or of the ``first`` most persistent ones.

    ``tx`` is read more than once: pass a stored table.
    """
    counts = activity.user_day_counts(tx, sizes_from=tx)
    users = activity.persistent_users(counts, min_cnt, min_days, first)
    return structuring_profile(tx, users, limit)
