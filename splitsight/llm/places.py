"""Places in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from splitsight.session import stored


def numbered(rows: DataFrame, order: list[Column], name: str = "at") -> DataFrame:
    """The rows with their place from 0 in the order; one sort over all tasks.

    A place is the number in the sorted partition plus the rows of the partitions before. Give stored rows and
    an order without ties: the sort samples them first.
    """
    ordered = stored(rows.orderBy(*order).withColumn("_seen", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_seen", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # One row per partition of the sort.
    sizes = F.broadcast(sizes.select("_part", before.alias("_before")))
    place = F.col("_before") + F.col("_seen").bitwiseAND(2**33 - 1)
    return ordered.withColumn("_part", part).join(sizes, "_part").select(*rows.columns, place.alias(name))
