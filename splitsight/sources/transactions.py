"""Reading transaction and feature tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitsight.operators.clean import coerce_transactions


def read_transactions(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A transaction table as stored; giving the schema saves the footer read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_coerced(spark: SparkSession, path: str, date_formats: Sequence[str] = ()) -> DataFrame:
    return coerce_transactions(read_transactions(spark, path), date_formats)


def union_strict(*tables: DataFrame) -> DataFrame:
    """Bag union of tables whose column lists are equal, order included."""
    first = tables[0]
    for other in tables[1:]:
        if other.columns != first.columns:
            raise ValueError(f"column lists differ: {first.columns} and {other.columns}")
    result = first
    for other in tables[1:]:
        result = result.unionByName(other)
    return result


def row_counts(**tables: DataFrame) -> DataFrame:
    """Rows per named table and in total; the tables are taken as disjoint."""
    sizes = None
    for name, table in tables.items():
        size = table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
        sizes = size if sizes is None else sizes.unionByName(size)
    total = sizes.agg(F.sum("rows").alias("rows")).select(F.lit("total").alias("source"), "rows")
    return sizes.unionByName(total)


def day_folders(spark: SparkSession, path: str, days: Iterable[date]) -> list[str]:
    """The folders of the given days that a year/month/day table has.

    Only the table's folder and those of the years and months in question are listed.
    """
    wanted = sorted({tuple(d.timetuple()[:3]) for d in days})
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(root, ())]
    for depth, name in enumerate(("year", "month", "day"), start=1):
        heads = {w[:depth] for w in wanted}
        below = []
        for folder, numbers in found:
            for entry in files.listStatus(folder):
                key, _, value = entry.getPath().getName().partition("=")
                if key == name and value.isdigit() and (*numbers, int(value)) in heads:
                    below.append((entry.getPath(), (*numbers, int(value))))
        found = below
    return [folder.toString() for folder, _ in sorted(found, key=lambda f: f[1])]


def read_days(spark: SparkSession, path: str, days: Iterable[date], schema: T.StructType | None = None) -> DataFrame:
    """Some days of a year/month/day table, from their folders alone.

    With the ``schema`` of the files no footer is read. Without one, and if none of the days is there, the whole
    table is listed for its columns.
    """
    folders = day_folders(spark, path, days)
    if folders:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.option("basePath", path).parquet(*folders)
    if schema is None:
        return spark.read.parquet(path).where(F.lit(False))
    parts = [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")]
    return spark.createDataFrame([], T.StructType([*schema.fields, *parts]))


def read_partitioned(
    spark: SparkSession, path: str, start: str | date, end: str | date, schema: T.StructType | None = None
) -> DataFrame:
    """Days ``start`` to ``end`` (both included) of a year/month/day table.

    A missing day is simply absent. ``date`` is rebuilt from the partition columns if the table lacks it.
    """
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    if last < first:
        raise ValueError("the end of the range lies before its start")
    table = read_days(spark, path, [first + timedelta(days=n) for n in range((last - first).days + 1)], schema)
    day = F.make_date("year", "month", "day")
    kept = table.where((day >= F.lit(first)) & (day <= F.lit(last)))
    if "date" not in table.columns:
        kept = kept.withColumn("date", day)
    return kept


def read_day(spark: SparkSession, path: str, day: str | date, schema: T.StructType | None = None) -> DataFrame:
    return read_partitioned(spark, path, day, day, schema)
