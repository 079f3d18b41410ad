"""Near-duplicate vectors by products of int8 tiles.

Every vector is scaled to length one in double precision and rounded to int8 with a scale of its own. For codes q,
scales s and residuals r (x = s q + r) the cosine of two vectors differs from the product of their codes,
s s' q.q', by at most |s q| |r'| + |r| |s' q'| + |r| |r'|: both norms are computed per vector, so every pair has a
rigorous interval. Vectors are dealt into blocks by a hash, and a task multiplies one block of codes with
another. Pairs whose interval ends below the threshold are dropped, those whose interval begins above it
are links; only where it holds the threshold are the two vectors compared in full precision, in a second
step that reads the rows concerned and no others.

A tile returns a row per vector that has a link in it, with the number of its links and the least vector it hangs
together with inside the tile: never its pairs. Equal vectors are one vector with a count, so a group of
copies of any size is one row. A block has a bounded number of bytes; codes are shuffled once per block, which makes all pairs of
n vectors n^2 / 2 small products, as the method wants.

Cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and vectors of
different length don't link; null ids take part, the least id of a component is taken over the others, and a row
whose id is null isn't kept unless no row of the component has one; rows that repeat an id are vectors of
their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.llm.components import components
from splitsight.session import stored

THRESHOLD = 0.95
# Rows of a block at most, and bytes of its codes as numbers.
BLOCK_ROWS, BLOCK_BYTES = 4096, 64 << 20
# Codes of a product that single precision adds up exactly: 127 * 127 * 1024 < 2 ** 24.
EXACT = 1024
# More than what rounding in double precision can add to an interval.
SLACK = 1e-9
# Products, and components of pairs, looked at together.
PART, PAIRS = 1 << 21, 1 << 22


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, norm of scale * codes, norm of the residual) of unit vectors, row by row."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None])
    near = scale[:, None] * codes
    return codes.astype(np.int8), scale, np.linalg.norm(near, axis=1), np.linalg.norm(x - near, axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


CODED = "row long, digest binary, dim int, codes binary, scale double, near double, rest double"


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, vector) to CODED, without the vectors that can't link."""
    for batch in batches:
        column = batch.column(1)
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        first = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths[lengths > 0]).tolist():
            at = np.flatnonzero(lengths == dim)
            x = values[first[at][:, None] + np.arange(dim)] + 0.0
            there = np.isfinite(x).all(axis=1) & x.any(axis=1)
            at, x = at[there], x[there]
            digests = [hashlib.sha256(row.tobytes()).digest() for row in x]
            codes, scale, near, rest = quantised(unit(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column(0).to_numpy()[at]), pa.array(digests, pa.binary()), pa.array(np.full(len(at), dim, np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), *map(pa.array, (scale, near, rest))],
                ["row", "digest", "dim", "codes", "scale", "near", "rest"],
            )


class Block:
    """The columns of one side of a tile as arrays."""

    def __init__(self, table: pa.Table):
        self.heads = table["head"].to_numpy()
        self.copies = table["copies"].to_numpy()
        self.scale, self.near, self.rest = (table[c].to_numpy() for c in ("scale", "near", "rest"))
        codes = b"".join(table["codes"].to_pylist())
        self.codes = np.frombuffer(codes, np.int8).reshape(len(self.heads), -1)
        self.vectors = None
        if "vector" in table.column_names:
            values = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            self.vectors = unit(values.reshape(len(self.heads), -1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of two int8 tiles."""
    if a.shape[1] <= EXACT:
        return a.astype(np.float32) @ b.astype(np.float32).T
    return sum((products(a[:, k : k + EXACT], b[:, k : k + EXACT]) for k in range(0, a.shape[1], EXACT)), np.float64(0))


def _cosines(a: Block, b: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In double precision, a bounded number of components at a time."""
    step = max(1, PAIRS // a.codes.shape[1])
    parts = [np.einsum("ij,ij->i", a.vectors[i[k : k + step]], b.vectors[j[k : k + step]]) for k in range(0, len(i), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Gives the nodes that hang together by (i, j), or did before, one label: the least of them."""
    while True:
        while not np.array_equal(label, above := label[label]):
            label[:] = above
        one, two = label[i], label[j]
        apart = one != two
        if not apart.any():
            return
        i, j, one, two = i[apart], j[apart], one[apart], two[apart]
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))


def linked(a: Block, b: Block, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a tile: links, label and uncertain pairs of every vector, those of ``a`` first, ``b`` only if it is another.

    With vectors at hand the uncertain pairs are decided, and only their links are told.
    """
    n = len(a.heads)
    total = n if same else n + len(b.heads)
    links, unsure, label = np.zeros(total, np.int64), np.zeros(total, np.int64), np.arange(total)
    widest = a.near * b.rest.max() + a.rest * (b.near.max() + b.rest.max())
    for at in range(0, n, step := max(1, PART // max(len(b.heads), 1))):
        rows = slice(at, at + step)
        found = products(a.codes[rows], b.codes)
        # Below this no scale and error of the other side lift a product to the threshold.
        least = threshold - widest[rows] - SLACK
        least /= a.scale[rows] * np.where(least > 0, b.scale.max(), b.scale.min())
        i, j = np.nonzero(found >= np.floor(least - 0.5).astype(found.dtype)[:, None])
        about = found[i, j].astype(np.float64)
        i += at
        if same:
            upper = j > i
            i, j, about = i[upper], j[upper], about[upper]
        about *= a.scale[i] * b.scale[j]
        error = a.near[i] * b.rest[j] + a.rest[i] * (b.near[j] + b.rest[j]) + SLACK
        certain, possible = about - error >= threshold, about + error >= threshold
        other = j if same else j + n
        if a.vectors is None:
            open_pairs = possible & ~certain
            for side in (i, other):
                unsure += np.bincount(side[open_pairs], minlength=total)
            chosen = certain
        else:
            chosen = possible & ~certain
            chosen[chosen] = _cosines(a, b, i[chosen], j[chosen]) >= threshold
        i, j, other = i[chosen], j[chosen], other[chosen]
        np.add.at(links, i, b.copies[j])
        np.add.at(links, other, a.copies[i])
        _joined(label, i, other)
    return links, label, unsure


LINKED = "dim int, a int, b int, head long, links long, root long, unsure boolean"


def _tile(threshold: float) -> Callable[[tuple, pa.Table], pa.Table]:
    def work(key: tuple, table: pa.Table) -> pa.Table:
        dim, one, two = (k.as_py() for k in key)
        first = pc.equal(table["block"], one)
        a = Block(table.filter(first))
        same = one == two
        b = a if same else Block(table.filter(pc.invert(first)))
        heads = a.heads if same else np.concatenate([a.heads, b.heads])
        if not len(a.heads) or not len(b.heads):
            links, label, unsure = np.zeros(len(heads), np.int64), np.arange(len(heads)), np.zeros(len(heads), np.int64)
        else:
            links, label, unsure = linked(a, b, same, threshold)
        told = np.flatnonzero((links > 0) | (unsure > 0))
        fixed = [pa.array(np.full(len(told), v, np.int32)) for v in (dim, one, two)]
        return pa.Table.from_arrays(
            [*fixed, pa.array(heads[told]), pa.array(links[told]), pa.array(heads[label[told]]), pa.array(unsure[told] > 0)], ["dim", "a", "b", "head", "links", "root", "unsure"]
        )

    return work


def _blocks(rows: int, dim: int, partitions: int) -> int:
    """Blocks such that each has a bounded size and there are tiles enough for all tasks."""
    bounded = math.ceil(rows / max(64, min(BLOCK_ROWS, BLOCK_BYTES // (4 * max(dim, 1)))))
    busy = min(math.ceil(math.sqrt(4 * partitions)), math.ceil(rows / 64))
    return max(bounded, busy, 1)


def vector_components(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` is the number of other rows whose cosine is at least ``threshold`` (above 0), ``component_id`` the least id
    reachable by links, and ``kept`` says that it is the row's own.
    """
    if threshold <= 0:
        raise ValueError("the threshold has to be above 0")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "vectors")
    coded = stored(rows.select("row", "vector").mapInArrow(_coded, CODED), "vector-codes")
    own = ("dim", "codes", "scale", "near", "rest")
    heads = stored(coded.groupBy("digest").agg(F.min("row").alias("head"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in own]), "vector-heads")
    size = heads.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    blocks = _blocks(size["n"], size["dim"] or 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = heads.withColumn("block", F.pmod(F.xxhash64("head"), F.lit(blocks)).cast("int"))
    tiled = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiled = tiled.select("head", "copies", *own, "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    found = stored(tiled.groupBy("dim", "a", "b").applyInArrow(_tile(threshold), LINKED), "vector-links")
    # The rows of uncertain pairs once more, with their vectors.
    open_rows = found.where("unsure").select("a", "b", "head").join(dealt, "head").join(rows.select(F.col("row").alias("head"), "vector"), "head")
    decided = stored(open_rows.groupBy("dim", "a", "b").applyInArrow(_tile(threshold), LINKED), "vector-decided")
    every = found.unionByName(decided).where("links > 0")
    links = every.groupBy("head").agg(F.sum("links").alias("links"))
    roots = components(every.select(F.col("head").alias("a"), F.col("root").alias("b")), "vector-components")
    # From heads to components and back to the rows.
    placed = heads.select("digest", "head", "copies").join(links, "head", "left").join(roots.withColumnRenamed("node", "head"), "head", "left")
    placed = stored(placed.select("digest", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "head").alias("root")), "vector-heads")
    members = coded.select("row", "digest").join(placed, "digest").join(rows.select("row", "id"), "row")
    members = stored(members.select("row", "id", "root", (F.col("links") + F.col("copies") - 1).alias("n_links")), "vector-members")
    least = stored(members.groupBy("root").agg(F.min("id").alias("component_id")), "vector-least")
    linked_rows = members.join(least, "root").select("id", "n_links", "component_id", "row")
    alone = rows.join(coded.select("row"), "row", "left_anti").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), "row")
    out = linked_rows.unionByName(alone)
    return out.select(F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
