"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text. A batch is reduced to one row per
digest, sort-merge anti-joined with the index and what is new is appended; the index side of that join
needs neither a shuffle nor, with one file per bucket, a sort.

A table without an index of its own is read in two batches, the larger ids first, against an index that is made
for it: what the second batch repeats of the first falls to the anti-join, and the largest id of a text stays.

Cases: a null text counts as empty, and empty texts are equal; of equal texts the largest id stays, a
null id only where there is no other; of rows that agree in id and text one stays; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitsight.llm.words import free_name
from splitsight.session import scratch_path, stored


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the UTF-8 text as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


class DigestIndex:
    """Digests seen so far with the id that stays and the number of rows, in ``path``.

    ``buckets`` belongs to the stored table: open it again with the same number. A batch that failed
    before its commit left nothing; one that is given again appends nothing.
    """

    COLUMNS = "digest BINARY, keep_id {kind}, group_size BIGINT"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, id_type: str = "bigint"):
        self.spark = spark
        self.path = path or scratch_path(spark, "digests")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({self.COLUMNS.format(kind=id_type)}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, heads: DataFrame) -> DataFrame:
        """The rows of ``heads`` whose digest the index doesn't hold."""
        return heads.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, heads: DataFrame) -> None:
        """Adds the unseen rows of ``heads`` (digest, keep_id, group_size; one row per digest)."""
        fresh = self.unseen(heads).select("digest", "keep_id", "group_size")
        # One file for each bucket keeps the order on disk.
        fresh.repartition(self.buckets, "digest").write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Forgets the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *error) -> None:
        self.close()


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Stored (id, digest, row): the row number only tells repeated rows apart."""
    return stored(docs.select(F.col(doc_id).alias("id"), text_digest(text).alias("digest"), F.monotonically_increasing_id().alias("row")), "digested")


def _taken(marked: DataFrame, index: DigestIndex) -> DataFrame:
    """Stored heads of a batch: digest, keep_id, keep_row, ``fresh``; what is new has gone to the index."""
    # Nulls order first in a struct, so any id wins over none.
    heads = stored(
        marked.groupBy("digest")
        .agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("group_size"))
        .select("digest", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"),
        "digest-heads",
    )
    fresh = stored(index.unseen(heads).select("digest", "keep_row"), "digest-fresh")
    index.append(heads)
    # Both sides are read from plain files, so that a digest with very many rows can be split.
    known = index.rows().alias("i").join(heads.alias("h"), "digest").join(fresh.alias("f"), "digest", "left")
    return stored(known.select("digest", "i.keep_id", "h.group_size", "f.keep_row"), "digest-known")


def _labelled(marked: DataFrame, known: DataFrame, doc_id: str) -> DataFrame:
    return marked.join(known.hint("merge"), "digest").select(
        F.col("id").alias(doc_id), "keep_id", "group_size", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"), "digest"
    )


def exact_groups(docs: DataFrame, index: DigestIndex | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    With an index, a text that it holds already is kept nowhere in this batch and ``keep_id`` is the
    id in the index; ``group_size`` counts the rows of this batch. Without one, both are those of the whole table.
    """
    marked = _marked(docs, doc_id, text)
    if index is not None:
        return _labelled(marked, _taken(marked, index), doc_id)
    # Any id does to part the batches; null ids, which no text keeps beside others, are in the last.
    kind = marked.schema["id"].dataType
    middle = F.percentile_approx("id", 0.5) if isinstance(kind, T.NumericType) else F.expr("any_value(id, true)")
    later = F.coalesce(F.col("id") >= F.lit(marked.agg(middle).first()[0]).cast(kind), F.lit(False))
    with DigestIndex(docs.sparkSession, id_type=marked.schema["id"].dataType.simpleString()) as own:
        parts = [_taken(marked.where(part), own) for part in (later, ~later)]
        # A digest's rows in both batches; the row that stays is in one of them.
        both = parts[0].unionByName(parts[1]).groupBy("digest")
        known = both.agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.max("keep_row").alias("keep_row"))
        known = stored(known, "digest-known")
    return _labelled(marked, known, doc_id)


def without_copies(docs: DataFrame, index: DigestIndex | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The whole rows that stay: one per new text, that with the largest id.

    ``row_number() = 1`` is cut to a row per digest and task before the shuffle, so a text with very
    many copies reaches no task as a group.
    """
    digest, rank = free_name(docs, "digest"), free_name(docs, "copy")
    index = index or DigestIndex(docs.sparkSession, id_type=docs.schema[doc_id].dataType.simpleString())
    first = docs.withColumn(digest, text_digest(text)).withColumn(
        rank, F.expr(f"row_number() OVER (PARTITION BY `{digest}` ORDER BY `{doc_id}` DESC NULLS LAST)")
    )
    chosen = first.where(F.col(rank) == 1).drop(rank)
    seen = index.rows().select(F.col("digest").alias(digest))
    rows = stored(chosen.join(seen.hint("merge"), digest, "left_anti"), "exact-kept")
    index.append(rows.select(F.col(digest).alias("digest"), F.col(doc_id).alias("keep_id"), F.lit(1).cast("bigint").alias("group_size")))
    return rows.select(docs.columns)
