"""Jaccard join of documents on word shingles with a MinHash LSH forest.

1. Every text becomes its set of five-word shingles; texts with equal sets form a class.
2. Each class gets ``TREES`` MinHash sequences. In each tree, classes that share a prefix of the
   sequence are candidates; from ``DEPTH`` on the prefix is shortened until a pair at the threshold meets in
   some tree with the wanted probability. Prefixes held by one class go.
3. Candidate classes are grouped into connected components of shared prefixes. All pairs of a
   component are compared exactly, block against block by matrix products of shingle incidence, so that
   a block pair makes one row per member whatever the number of links.
4. Links between classes, counted with the classes' sizes, and their components are the result.

Cases: a null or wordless text has no shingles and is linked to nothing, a text of fewer than five words
is one shingle; equal sets are links; rows are counted one by one, repeated rows too; null ids are kept, the
class id is the least id that isn't null; an empty table gives no rows; other columns are passed on unread.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.llm.components import components
from splitsight.llm.words import WordHashes, free_name, mixed, shingles, tasks_over, utf8, words
from splitsight.session import stored

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 40, 10
TARGET = 0.999
# Classes in a block of a component; pairs of blocks are compared by one call each.
BLOCK = 256


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree often enough."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingle_set(found: list[bytes], hashes: WordHashes, size: int) -> np.ndarray:
    return np.unique(shingles(hashes.of(found), size))


def _seeds(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def tree_prefixes(grams: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """One hash of the first ``depth`` MinHash values per tree."""
    seeds = _seeds(trees * depth)
    least = np.full(len(seeds), ~np.uint64(0))
    for at in range(0, len(grams), 256):
        # Multiply-shift on mixed hashes; the high half is what is compared.
        part = (grams[at : at + 256, None] * seeds[None, :]) ^ (grams[at : at + 256, None] >> np.uint64(32))
        np.minimum(least, part.min(axis=0), out=least)
    values = mixed(least).reshape(trees, depth)
    out = np.arange(trees, dtype=np.uint64)
    for k in range(depth):
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + values[:, k])
    return out


def signatures(docs: DataFrame, doc_id: str, text: str, size: int, trees: int, depth: int) -> DataFrame:
    """Per row: id, row and its key, digest of the shingle set (null if empty), number of shingles, tree prefixes."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in tasks_over(batches):
            digests, sizes, prefixes = [], [], []
            for t in utf8(batch.column(text)):
                grams = shingle_set(words(t), hashes, size)
                sizes.append(len(grams))
                digests.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                prefixes.append(tree_prefixes(grams, trees, depth).view(np.int64) if len(grams) else None)
            columns = [batch.column(doc_id), batch.column("key"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "digest", "n", "prefixes"])

    kind = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(doc_id, text, F.xxhash64(doc_id, text).alias("key"))
    signed = docs.mapInArrow(sign, f"id {kind}, key long, digest binary, n int, prefixes array<long>")
    return signed.withColumn("row", F.monotonically_increasing_id())


def _sets(docs: DataFrame, doc_id: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """``wanted`` (id, digest, ...) with the shingles of each class, read again from its least document."""
    rest = [c for c in wanted.columns if c not in ("id", "digest")]
    joined = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(wanted, F.col("_id").eqNullSafe(F.col("id"))).drop("_id", "id")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in tasks_over(batches):
            digests = batch.column("digest").to_pylist()
            grams = [shingle_set(words(t), hashes, size) for t in utf8(batch.column("_text"))]
            # Rows with one id may have several texts; only that of the class counts.
            own = [xxhash.xxh3_128_digest(g.tobytes()) == d for g, d in zip(grams, digests, strict=True)]
            batch = batch.append_column("grams", pa.array([g.view(np.int64) for g in grams], pa.list_(pa.int64())))
            yield batch.filter(pa.array(own, pa.bool_())).select(["digest", *rest, "grams"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema if f.name in rest)
    return joined.mapInArrow(read, f"digest binary, {kinds}, grams array<long>")


def incidence_links(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether the Jaccard similarity of each set of ``left`` with each of ``right`` reaches the threshold."""
    sizes = [np.array([len(g) for g in side], np.float64) for side in (left, right)]
    common = np.zeros((len(left), len(right)))
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    rows = [np.repeat(np.arange(len(side)), [len(g) for g in side]) for side in (left, right)]
    places = []
    for grams, owner in ((a, rows[0]), (b, rows[1])):
        at = np.searchsorted(shared, grams)
        there = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == grams) if len(shared) else np.zeros(len(grams), bool)
        places.append((owner[there], at[there]))
    width = 4096
    for low in range(0, len(shared), width):
        sides = []
        for (owner, at), side in zip(places, (left, right), strict=True):
            inside = (at >= low) & (at < low + width)
            matrix = np.zeros((len(side), min(width, len(shared) - low)), np.float32)
            matrix[owner[inside], at[inside] - low] = 1
            sides.append(matrix)
        common += sides[0] @ sides[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - common
    # Against rounding: compared without a division.
    return common >= threshold * union - 1e-9


def compared(sets: DataFrame, threshold: float) -> DataFrame:
    """(digest, root, links): links counted with class sizes, roots joined within each group.

    Groups hold small components whole (``part`` -1) or a pair of blocks of a large one; sets of one
    class occur once in a group.
    """

    def compare(rows: pa.Table) -> pa.Table:
        digests, comps, parts, weights, blocks = (rows[c].to_pylist() for c in ("digest", "component", "part", "weight", "block"))
        grams = [np.asarray(g.values).view(np.uint64) for g in rows["grams"].combine_chunks()]
        found: dict[bytes, list] = {}
        members: dict[tuple, dict[int, list[int]]] = {}
        seen = set()
        for i, (d, c, p) in enumerate(zip(digests, comps, parts, strict=True)):
            if (d, p) not in seen:
                seen.add((d, p))
                members.setdefault((c, p), {}).setdefault(blocks[i], []).append(i)
                found.setdefault(d, [d, 0])
        parent: dict[bytes, bytes] = {d: d for d in found}

        def root(d: bytes) -> bytes:
            while parent[d] != d:
                parent[d] = parent[parent[d]]
                d = parent[d]
            return d

        for (_, part), sides in members.items():
            # Part i * 10^9 + j compares block i with block j, and a block with itself if they are equal.
            same = part < 0 or part // 1_000_000_000 == part % 1_000_000_000
            if len(sides) != (1 if same else 2):
                continue
            first, second = [*sides.values(), *sides.values()][:2]
            linked = incidence_links([grams[i] for i in first], [grams[i] for i in second], threshold)
            if same:
                np.fill_diagonal(linked, False)
            for side, other, matrix in ((first, second, linked),) if same else ((first, second, linked), (second, first, linked.T)):
                for i, n in zip(side, (matrix @ np.array([weights[i] for i in other], np.int64)).tolist(), strict=True):
                    found[digests[i]][1] += n
            for i, row in zip(first, linked, strict=True):
                own = root(digests[i])
                for other in {root(digests[second[k]]) for k in np.flatnonzero(row)} - {own}:
                    low, high = sorted((own, other))
                    parent[high] = own = low
        out = [(d, root(d), n) for d, n in found.values()]
        return pa.table({"digest": pa.array([x[0] for x in out], pa.binary()), "root": pa.array([x[1] for x in out], pa.binary()), "links": pa.array([x[2] for x in out], pa.int64())})

    return sets.groupBy("task").applyInArrow(compare, "digest binary, root binary, links long")


def jaccard_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    target: float = TARGET,
) -> DataFrame:
    """Per row: id, ``class_id`` (least id of all documents linked directly or not), ``n_links``.

    ``n_links`` counts the other rows at the threshold or above. Stored.
    """
    spark = docs.sparkSession
    depth = prefix_depth(threshold, trees, depth, target)
    rows = stored(signatures(docs, doc_id, text, size, trees, depth), "signatures")
    full = rows.where("digest IS NOT NULL")
    classes = stored(
        full.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.first("prefixes").alias("prefixes")),
        "classes",
    )
    spread = classes.select("digest", F.posexplode("prefixes").alias("tree", "prefix"))
    # The prefix hash covers the tree's number.
    centres = spread.groupBy("prefix").agg(F.min("digest").alias("b"), F.count("*").alias("n")).where("n > 1").select("prefix", "b")
    edges = spread.select(F.col("digest").alias("a"), "prefix").join(stored(centres, "centres"), "prefix").select("a", "b").distinct()
    candidates = components(edges, "candidates")
    wanted = stored(
        candidates.select(F.col("node").alias("digest"), F.col("root").alias("component")).join(classes.select("digest", "id", "weight"), "digest"), "candidate-classes"
    )
    sizes = wanted.groupBy("component").agg(F.count("*").alias("size"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Blocks of a large component are dealt by hash, so that no task ranks its members.
    n_blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    block = F.when(F.col("size") <= BLOCK, 0).otherwise(F.pmod(F.xxhash64("digest"), n_blocks)).cast("int")
    dealt = wanted.join(stored(sizes, "component-sizes"), "component").withColumn("block", block).withColumn("n_blocks", n_blocks)
    with_sets = stored(_sets(docs, doc_id, text, size, dealt.select("id", "digest", "component", "weight", "block", "n_blocks")), "candidate-sets")
    small = with_sets.where("n_blocks = 1").select("*", F.lit(-1).cast("long").alias("part"), F.pmod(F.xxhash64("component"), F.lit(8 * tasks)).alias("task"))
    # Block i meets block j in part (i, j) with i <= j.
    pair = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    large = with_sets.where("n_blocks > 1").select("*", pair.alias("other"))
    low, high = F.least("block", "other").cast("long"), F.greatest("block", "other").cast("long")
    large = large.withColumn("part", low * 1_000_000_000 + high).withColumn("task", F.xxhash64("component", "part")).drop("other")
    verified = stored(compared(small.unionByName(large), threshold), "verified")
    links = verified.groupBy("digest").agg(F.sum("links").alias("links"))
    roots = components(verified.select(F.col("digest").alias("a"), F.col("root").alias("b")), "linked")
    joined = classes.select("digest", "id", "weight").join(links, "digest", "left").join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left")
    joined = stored(joined.select("digest", "id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "digest").alias("root")), "class-links")
    least = joined.groupBy("root").agg(F.min("id").alias("class_id"))
    known = stored(joined.join(least, "root").select("digest", "root", "class_id", "n_links"), "class-ids")
    names = ["id", "row", "key", "root", "class_id", "n_links"]
    linked = full.select("id", "row", "key", "digest").join(known.hint("merge"), "digest").select(names)
    alone = rows.where("digest IS NULL").select("id", "row", "key", F.lit(None).cast("binary").alias("root"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone).withColumnRenamed("id", doc_id)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The whole rows that stay: of each class that with the least id; wordless texts all stay."""
    found = stored(jaccard_classes(docs, doc_id, text, **options).select("root", "key", F.col(doc_id).alias("id"), "row"), "jaccard")
    # Ids order before nulls.
    best = found.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "row", "key")).alias("best"))
    dropped = found.where("root IS NOT NULL").join(stored(best.select("root", F.col("best.row").alias("kept")), "jaccard-best"), "root").where("row <> kept")
    # A key whose every row goes needs no more than its absence; one with repeated rows keeps one.
    kept = stored(best.select(F.col("best.key").alias("key")), "jaccard-kept")
    gone = dropped.select("key").join(kept, "key", "left_anti").distinct()
    repeated = dropped.select("key").join(kept, "key", "left_semi").distinct()
    key = free_name(docs, "key")
    gone, repeated = (stored(x.withColumnRenamed("key", key), "jaccard-gone") for x in (gone, repeated))
    keyed = docs.withColumn(key, F.xxhash64(doc_id, text))
    rest = keyed.join(gone, key, "left_anti")
    if not repeated.isEmpty():
        rank = free_name(docs, "copy")
        numbered = rest.join(repeated, key, "left_semi").withColumn(rank, F.expr(f"row_number() OVER (PARTITION BY `{key}` ORDER BY `{doc_id}`)"))
        rest = rest.join(repeated, key, "left_anti").unionByName(numbered.where(F.col(rank) == 1).drop(rank))
    return rest.drop(key)
