"""A Merkle manifest of a table: leaves, subroots, the root and a proof for every row, without Python.

A row's leaf is the SHA-256 of its encoded columns. The leaves of a group, in order, are the first level; every
``fan_out`` consecutive nodes are a run and become their parent, the last run may be shorter. The subroots of
the groups, in order, are the leaves of the tree whose top is the root.

Levels are made by lag and lead windows. A node sits on the row of its first leaf, so siblings are a fixed
number of rows apart: at level l it is a multiple of ``fan_out ** l``. The lags as many as the slot of a node in
its run, and the leads that its run's length allows, are its siblings; first children hash them into
the parent. Windows hold aligned blocks of ``BLOCK`` leaves at most, whose tops are the leaves of the next tier, so
that a group of any size is spread over tasks; a tier costs one shuffle.

Cases: a null value is encoded as ``-``, an empty text as ``0:``; null keys and the null group come first; rows that
agree in all encoded columns are leaves of their own, beside each other; a lone leaf is its group's
subroot, a lone subroot the root; an empty table has no rows and no root; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from splitsight.llm.places import numbered
from splitsight.session import stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_OUT = 2
# Rows of a window at most.
BLOCK = 1024
STEPS = "array<struct<before:string,after:string>>"


def levels_of(fan_out: int, rows: int = BLOCK) -> int:
    """Levels in a window of at most ``rows`` rows, one at least."""
    levels = 1
    while fan_out ** (levels + 1) <= rows:
        levels += 1
    return levels


def encoded(value: str | Column) -> Column:
    """Byte count, colon, value; ``-`` for null."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(columns: Sequence[str] = COLUMNS, **instead: Column) -> Column:
    """The leaf of a row; ``instead`` gives other values for columns."""
    return digest(*[encoded(instead.get(c, F.col(f"`{c}`"))) for c in columns])


def _tier(nodes: DataFrame, fan_out: int, levels: int) -> DataFrame:
    """``nodes`` (tree, pos, size, hash) with ``block``, ``path`` and ``top``.

    ``path`` holds a node's steps up to the top of its block: the hashes of its siblings before and after, level by
    level. ``top`` is the hash of the block's top, on the block's first row.
    """
    rows = nodes.withColumn("block", F.expr(f"pos div {fan_out**levels}")).withColumn("top", F.col("hash"))
    block = W.partitionBy("tree", "block").orderBy("pos")
    for level in range(levels):
        width = fan_out**level
        near = {f"_lag{k}": F.lag("top", k * width).over(block) for k in range(1, fan_out)}
        near |= {f"_lead{k}": F.lead("top", k * width).over(block) for k in range(1, fan_out)}
        rows = rows.withColumns(near)
        place = F.expr(f"pos div {width}")
        slot = place % fan_out
        run = F.least(F.lit(fan_out), F.ceil(F.col("size") / width) - (place - slot))
        # Nodes of this level; a level of one node has no parent.
        node, several = F.col("pos") % width == 0, F.col("size") > width
        before = F.concat(*[F.when(slot >= k, F.col(f"_lag{k}")).otherwise("") for k in range(fan_out - 1, 0, -1)])
        after = F.concat(*[F.when(slot + k < run, F.col(f"_lead{k}")).otherwise("") for k in range(1, fan_out)])
        rows = rows.withColumn(f"_step{level}", F.when(node & several, F.struct(before.alias("before"), after.alias("after"))))
        parent = digest(F.col("top"), F.col(f"_step{level}.after"))
        rows = rows.withColumn("top", F.when(~several, F.col("top")).when(node & (slot == 0), parent)).drop(*near)
    # The nodes above a row sit on it or on the last row before it that has a step of their level.
    so_far = block.rowsBetween(W.unboundedPreceding, 0)
    steps = [F.last(f"_step{level}", ignorenulls=True).over(so_far) for level in range(levels)]
    path = F.filter(F.array(*steps), lambda s: s.isNotNull())
    top = F.when(F.col("pos") == F.col("block") * fan_out**levels, F.col("top"))
    return rows.select(*nodes.columns, "block", path.alias("path"), top.alias("top"))


def climbed(nodes: DataFrame, fan_out: int = FAN_OUT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(tree, pos, path) of the nodes, ``path`` up to the tops of their trees, and (tree, hash) of the tops.

    ``nodes``: tree, pos (from 0, without gaps), size (nodes of the tree) and hash.
    """
    levels = levels_of(fan_out, block)
    most = nodes.agg(F.max("size")).first()[0] or 0
    tiers = []
    while True:
        tiers.append(stored(_tier(nodes, fan_out, levels), "merkle-tier"))
        size = F.ceil(F.col("size") / fan_out**levels).alias("size")
        nodes = tiers[-1].where("top IS NOT NULL").select("tree", F.col("block").alias("pos"), size, F.col("top").alias("hash"))
        most = -(-most // fan_out**levels)
        if most <= 1:
            break
    # From the top tier down: a block's path follows on those of its nodes.
    found = tiers[-1].select("tree", "pos", "path")
    for tier in reversed(tiers[:-1]):
        above = found.select("tree", F.col("pos").alias("block"), F.col("path").alias("above"))
        found = tier.join(above, ["tree", "block"]).select("tree", "pos", F.concat("path", "above").alias("path"))
    return found, nodes.select("tree", "hash")


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", columns: Sequence[str] = COLUMNS, fan_out: int = FAN_OUT, block: int = BLOCK, **more: Column
) -> DataFrame:
    """One stored row per row: ``key``, ``leaf``, ``subroot``, ``root``, ``path`` and the columns of ``more``.

    ``path`` holds the steps from the leaf to the root, as ``folded`` takes them.
    """
    own = [f"_more{i}" for i in range(len(more))]
    given = [value.alias(name) for value, name in zip(more.values(), own, strict=True)]
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("group"), leaf(columns).alias("leaf"), F.monotonically_increasing_id().alias("row"), *given)
    rows = numbered(stored(rows, "merkle-leaves"), [F.col(c).asc_nulls_first() for c in ("group", "key", "leaf", "row")])
    groups = stored(rows.groupBy("group").agg(F.min("at").alias("first"), F.count("*").alias("size")), "merkle-groups")
    # Groups go by their number, which is their place in the upper tree.
    numbers = numbered(groups, [F.col("group").asc_nulls_first()], "tree")
    rows = rows.join(numbers, rows["group"].eqNullSafe(numbers["group"])).select("key", "leaf", *own, "tree", (F.col("at") - F.col("first")).alias("pos"), "size")
    rows = stored(rows, "merkle-rows")
    paths, subroots = climbed(rows.select("tree", "pos", "size", F.col("leaf").alias("hash")), fan_out, block)
    subroots = stored(subroots, "merkle-subroots")
    uppers = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("pos"), F.lit(subroots.count()).cast("long").alias("size"), "hash")
    above, tops = climbed(uppers, fan_out, block)
    top = tops.first()
    above = above.select(F.col("pos").alias("tree"), F.col("path").alias("above")).join(subroots, "tree")
    found = rows.join(paths, ["tree", "pos"]).join(stored(above, "merkle-above"), "tree")
    return found.select(
        F.col("key").alias(key), "leaf", F.col("hash").alias("subroot"), F.lit(top and top["hash"]).cast("string").alias("root"),
        F.concat("path", "above").alias("path"), *[F.col(o).alias(n) for o, n in zip(own, more, strict=True)],
    )


def proof_digest(path: str | Column = "path") -> Column:
    """SHA-256 of the siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def folded(leaf_hash: str | Column, path: str | Column = "path") -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    start = F.col(leaf_hash) if isinstance(leaf_hash, str) else leaf_hash
    return F.aggregate(path, start, lambda node, s: digest(s["before"], node, s["after"]))
