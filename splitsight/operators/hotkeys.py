"""Finding the keys that are too big for one task, and keeping them apart.

A key with more than ``rows`` rows is hot, whatever the size of the table. Cold groups may be
handled with one exchange on the key; operators compute the hot ones with map-side combined aggregations
instead, and return the union of both. The results are equal, so the choice may rest on a sample: one that
shows a key at the limit about ``SAMPLED`` times, of which 70 % make it hot.

The check is one aggregation job over a sample of the key columns. It runs when the operator is called,
because its answer decides the shape of the plan: usually there is no hot key and the plan is the
cold one. Keys that are found are written to the shared folder; Spark sees their size when it picks the join.

The same job tells about how many rows there are, so that cold groups can be dealt to as many tasks as keep a
task's share, and with it the memory of its sorts, the same for a table of any size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.session import stored

SAMPLED = 1000
# Rows of a task that sorts whole groups several times over.
TASK_ROWS = 100_000
# A task that sorts or counts its rows once may hold more of them.
SORTED_ONCE = 4


@dataclass(frozen=True)
class HeatLimit:
    rows: int = 200_000


DEFAULT_HEAT = HeatLimit()


def dealt(df: DataFrame, rows: float, *keys: str) -> DataFrame:
    """``df`` of about ``rows`` rows with whole groups in each of two partitions or more, about ``TASK_ROWS`` rows in one."""
    return df.repartition(max(2, math.ceil(rows / TASK_ROWS)), *keys)


def too_large(sizes: DataFrame) -> bool:
    """Whether a shuffle partition of the session would hold more than a dealt task that sorts its rows once."""
    partitions = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sizes.count() > partitions * SORTED_ONCE * TASK_ROWS


def _weighed(df: DataFrame, keys: list[str], limit: HeatLimit) -> tuple[float, DataFrame | None]:
    """About how many rows there are, and the key combinations above the limit."""
    share = min(1.0, SAMPLED / max(limit.rows, 1))
    seen, bound = df.select(*keys), float(limit.rows)
    if share < 1:
        seen, bound = seen.sample(fraction=share, seed=0), 0.7 * SAMPLED
    counted = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    rows, most = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0))).first()
    above = counted.where(F.col("_rows") > bound).select(*keys)
    return rows / share, stored(above, "hot-keys") if most > bound else None


def hot_keys(df: DataFrame, keys: list[str], limit: HeatLimit = DEFAULT_HEAT) -> DataFrame | None:
    """Key combinations above the limit, None if there are none."""
    return _weighed(df, keys, limit)[1]


def _parted(df: DataFrame, keys: list[str], hot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    if hot is None:
        return df, None
    return df.join(hot, keys, "left_anti"), df.join(hot, keys, "left_semi")


def split_by_heat(
    df: DataFrame,
    keys: list[str],
    limit: HeatLimit = DEFAULT_HEAT,
) -> tuple[DataFrame, DataFrame | None]:
    """(cold rows, hot rows or None). Rows with a NULL key stay with the cold ones."""
    return _parted(df, keys, hot_keys(df, keys, limit))


def dealt_by_heat(
    df: DataFrame,
    keys: list[str],
    limit: HeatLimit = DEFAULT_HEAT,
    sizes_from: DataFrame | None = None,
    among: DataFrame | None = None,
    times: int = 1,
) -> tuple[DataFrame, DataFrame | None]:
    """As ``split_by_heat``, with the cold rows dealt to tasks by their keys, ``times`` as many rows in one as ``dealt`` gives it.

    ``sizes_from`` may be any table that holds at least the rows of ``df`` and is cheaper to count,
    such as the rows before deduplication or a join: its groups can only be bigger.

    With ``among`` only groups whose keys it holds are returned. The join of cold rows is dealt as well: it sorts them once, so that
    its tasks may hold twice the rows. AQE doesn't split such a join, so hot rows are joined apart.
    """
    rows, hot = _weighed(df if sizes_from is None else sizes_from, keys, limit)
    cold, hot = _parted(df, keys, hot)
    if among is not None:
        among = among.select(*keys)
        cold = cold.join(dealt(among, rows / 2, *keys), keys, "left_semi")
        hot = None if hot is None else hot.join(among, keys, "left_semi")
    return dealt(cold, rows / times, *keys), hot
