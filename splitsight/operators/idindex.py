"""Deduplication of a table that grows: an index of the ids that earlier batches have kept.

The index is a table bucketed and sorted by id. A new batch is reduced to one row per id, then
sort-merge anti-joined with the index, whose side needs no shuffle, and its ids are added.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splitsight.operators.clean import drop_duplicate_ids
from splitsight.session import stored


class IdIndex:
    """Ids kept so far, each with the name of its batch, in ``path``.

    ``buckets`` belongs to the stored table: open it again with the same number. Use it in a ``with`` block or call
    ``close``, which forgets the table's name and leaves its files.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"ids_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (id STRING, batch STRING) USING parquet "
            f"CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def __enter__(self) -> IdIndex:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    @staticmethod
    def _key() -> Column:
        """NULL ids are one id, as in ``drop_duplicate_ids``; a leading dot keeps them from the empty text."""
        return F.coalesce(F.concat(F.lit("."), F.col("_id").cast("string")), F.lit(""))

    def unseen(self, tx: DataFrame, batch: str) -> DataFrame:
        """The first row of each id that no other batch has kept."""
        others = self.spark.table(self.name).where(F.col("batch") != batch).select(F.col("id").alias("_key"))
        rows = drop_duplicate_ids(tx).withColumn("_key", self._key())
        return rows.join(others.hint("merge"), "_key", "left_anti").select(*tx.columns)

    def add(self, tx: DataFrame, batch: str) -> DataFrame:
        """``unseen`` rows, stored, after their ids have been added to the index.

        A batch that is given again under its name, because it failed later on, gets the same rows again.
        """
        rows = stored(self.unseen(tx, batch), "new-ids")
        ids = rows.select(self._key().alias("id"))
        fresh = ids.join(self.spark.table(self.name).select("id").hint("merge"), "id", "left_anti")
        # One file for each bucket keeps the order on disk.
        fresh = fresh.withColumn("batch", F.lit(batch)).repartition(self.buckets, "id")
        fresh.write.bucketBy(self.buckets, "id").sortBy("id").mode("append").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)
        return rows
