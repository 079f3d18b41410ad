"""Isolation forest on Spark (Liu, Ting and Zhou, ICDM 2008), reproducible from hash seeds.

*Sampling.* Every row gets one hash per tree; a tree takes the ``psi`` rows with the smallest hashes, of
which a bound leaves about ``4 * psi`` before anything is sorted. The bound saves work only: the sample
of a tree is the same for every bound, whatever the size of the table.

*Growth.* One group of at most ``psi`` rows per tree, grown where it lands. All choices are hashes
of (seed, tree, node), so a fit does not depend on how the rows are partitioned.

*Scoring.* The forest has at most ``trees * (2 * psi - 1)`` nodes whatever the size of the data.
It travels to the tasks inside a vectorised function that walks all rows of an Arrow batch at once.

Features are rounded before use, so that the order in which a sum was formed cannot move a row to
the other side of a split.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from splitsight.operators.quantiles import exact_quantiles
from splitsight.schema import MODEL_FEATURES
from splitsight.session import stored

# Sample size, forest size, expected share of anomalies, seed, Euler's constant.
SAMPLE_SIZE = 256
TREES = 100
CONTAMINATION = 0.01
SEED = 42
EULER_GAMMA = 0.5772156649015329

FEATURE_DIGITS = 6
SCORE_DIGITS = 12
HASH_HEX_DIGITS = 15
ROW_KEY = ["user_id", "date"]
NODE_SCHEMA = (
    "tree int, node long, depth int, feature int, threshold double, size long, is_leaf boolean"
)


@dataclass
class ForestModel:
    """The node table, bounded by the settings and held locally, and what is needed to score."""

    nodes: pd.DataFrame
    psi: int
    n_trees: int
    contamination: float | None
    seed: int
    features: list[str]
    offset: float
    scaling: dict[str, tuple[float, float]] | None = None

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)


def model_inputs(names: list[str], scaling: dict[str, tuple[float, float]] | None = None) -> list[Column]:
    """The ordered features as rounded doubles, NULL as 0, standardised if asked."""
    inputs = []
    for c in names:
        value = F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), FEATURE_DIGITS)
        if scaling:
            mean, std = scaling[c]
            value = (value - F.lit(mean)) / F.lit(std)
        inputs.append(value.alias(c))
    return inputs


def matrix(
    features: DataFrame,
    names: list[str] = MODEL_FEATURES,
    scaling: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """The row key and the model inputs."""
    return features.select(*ROW_KEY, *model_inputs(names, scaling))


def scaling_of(rows: DataFrame, names: list[str] = MODEL_FEATURES) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature; a constant feature gets deviation 1."""
    found = rows.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in names], *[F.stddev_pop(c).alias(f"{c}_std") for c in names]
    ).first()
    return {c: (found[f"{c}_mean"] or 0.0, found[f"{c}_std"] or 1.0) for c in names}


def average_path(n: float) -> float:
    """Expected depth of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def _row_key() -> Column:
    """The key of a row as texts, formed once for the hashes of all trees."""
    return F.array(*[F.col(c).cast("string") for c in ROW_KEY])


def _sample_hash(key: Column, tree: Column, seed: int) -> Column:
    return F.substring(F.md5(F.concat_ws("|", key, tree.cast("string"), F.lit(str(seed)))), 1, HASH_HEX_DIGITS)


def _below(share: float) -> str:
    """The bound under which ``share`` of all hashes lie; from 1 on a text above every hash."""
    return format(int(share * 16**HASH_HEX_DIGITS), f"0{HASH_HEX_DIGITS}x") if share < 1.0 else "g"


def draw_samples(rows: DataFrame, n_rows: int, psi: int, n_trees: int, seed: int, spare: float = 4.0) -> DataFrame:
    """``psi`` rows per tree, drawn without replacement from all rows: those with the smallest hashes.

    A bound leaves ``spare`` times the rows that a tree needs to be ranked. What lies above it cannot be
    drawn as long as ``psi`` rows lie below; a tree that gets fewer is seen by its root being too small.
    """
    rank = F.row_number().over(W.partitionBy("tree").orderBy("_h", *ROW_KEY))
    return (
        rows.withColumn("_key", _row_key())
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
        .withColumn("_h", _sample_hash(F.col("_key"), F.col("tree"), seed))
        .where(F.col("_h") < _below(spare * psi / max(n_rows, 1)))
        .drop("_key")
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= psi)
        .drop("_rank", "_h")
    )


def _grower(names: list[str], psi: int, seed: int):
    height = math.ceil(math.log2(max(psi, 2)))

    def fraction(text: str) -> float:
        """Number in [0, 1) from a text."""
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2.0**32

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        values = group[names].to_numpy(dtype=float)
        grown = []
        pending = [(0, 0, np.arange(len(values)))]
        while pending:
            node, depth, members = pending.pop()
            block = values[members]
            low, high = block.min(axis=0), block.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= height or len(usable) == 0:
                grown.append((tree, node, depth, -1, 0.0, len(members), True))
                continue
            chosen = int(usable[int(fraction(f"f|{seed}|{tree}|{node}") * len(usable))])
            lo, hi = float(low[chosen]), float(high[chosen])
            cut = lo + fraction(f"t|{seed}|{tree}|{node}") * (hi - lo)
            cut = lo if cut >= hi else cut
            grown.append((tree, node, depth, chosen, cut, len(members), False))
            left = block[:, chosen] <= cut
            pending.append((2 * node + 1, depth + 1, members[left]))
            pending.append((2 * node + 2, depth + 1, members[~left]))
        return pd.DataFrame(
            grown, columns=["tree", "node", "depth", "feature", "threshold", "size", "is_leaf"]
        )

    return grow


def grow_forest(samples: DataFrame, names: list[str], psi: int, seed: int) -> DataFrame:
    """Node table of all trees; children of node n are 2n+1 (value <= threshold) and 2n+2."""
    return samples.groupBy("tree").applyInPandas(_grower(names, psi, seed), NODE_SCHEMA)


def _forest_arrays(nodes: pd.DataFrame):
    """Per tree: feature, threshold, left child, right child, path length and height, as arrays."""
    arrays = []
    for _, part in nodes.groupby("tree"):
        part = part.sort_values("node")
        ids = part["node"].to_numpy(np.int64)
        leaf = part["is_leaf"].to_numpy(bool)
        own = np.arange(len(ids))
        left = np.where(leaf, own, np.searchsorted(ids, 2 * ids + 1))
        right = np.where(leaf, own, np.searchsorted(ids, 2 * ids + 2))
        length = part["depth"].to_numpy(float) + np.array([average_path(float(n)) for n in part["size"]])
        feature = np.where(leaf, 0, part["feature"].to_numpy(int))
        arrays.append((feature, part["threshold"].to_numpy(float), left, right, length, int(part["depth"].max())))
    return arrays


def _isolation_score(nodes: pd.DataFrame, psi: int):
    forest = _forest_arrays(nodes)
    norm = average_path(float(psi))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            values = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            rows = np.arange(len(values))
            total = np.zeros(len(values))
            for feature, threshold, left, right, length, height in forest:
                at = np.zeros(len(values), dtype=np.int64)
                for _ in range(height):
                    goes_left = values[rows, feature[at]] <= threshold[at]
                    at = np.where(goes_left, left[at], right[at])
                total += length[at]
            depth = total / len(forest)
            yield pd.Series(-np.exp2(-depth / norm) if norm > 0 else np.full(len(values), -0.5))

    # The score depends on its row alone. The mark keeps the optimizer from copying the call into
    # inferred filters, which would walk the forest twice.
    return score.asNondeterministic()


def sample_score(nodes: pd.DataFrame, psi: int, inputs: list[Column]) -> Column:
    """Score of a row: lower is more anomalous."""
    return F.round(_isolation_score(nodes, psi)(*inputs), SCORE_DIGITS)


def grow(
    features: DataFrame,
    n_trees: int = TREES,
    sample_size: int = SAMPLE_SIZE,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
    scale: bool = False,
    names: list[str] = MODEL_FEATURES,
) -> ForestModel:
    """The trees for the given user-days (already filtered by activity), without an offset.

    The rows are read several times; pass a stored table.
    """
    n_rows = features.count()
    if n_rows == 0:
        raise ValueError("no rows to train on")
    scaling = scaling_of(matrix(features, names), names) if scale else None
    rows = matrix(features, names, scaling)
    psi = min(sample_size, n_rows)
    spare, roots = 4.0, None
    # At most n_trees * (2 * psi - 1) nodes, whatever the size of the data.
    while roots is None or len(roots) < n_trees or roots.min() < psi:
        nodes = grow_forest(draw_samples(rows, n_rows, psi, n_trees, seed, spare), names, psi, seed).toPandas()
        roots = nodes.loc[nodes["node"] == 0, "size"]
        spare *= 4
    return ForestModel(nodes, psi, n_trees, contamination, seed, list(names), 0.0, scaling)


def calibrate(model: ForestModel, features: DataFrame) -> tuple[ForestModel, DataFrame]:
    """The model with its offset, and ``features`` scored by it (stored)."""
    score = sample_score(model.nodes, model.psi, model_inputs(model.features, model.scaling))
    scored = stored(features.withColumn("_score", score), "scores")
    offset = exact_quantiles(scored, "_score", {"offset": model.contamination}).first()["offset"]
    model = replace(model, offset=offset)
    return model, _decided(scored, F.col("_score"), offset).drop("_score")


def fit(features: DataFrame, **options) -> ForestModel:
    """Grows and calibrates; options as for ``grow``."""
    return calibrate(grow(features, **options), features)[0]


def _decided(features: DataFrame, score: Column, offset: float) -> DataFrame:
    decided = features.withColumn("anomaly_score", F.round(score - F.lit(offset), SCORE_DIGITS))
    return decided.withColumn("flag_suspicious", F.col("anomaly_score") < 0)


def decision_scores(features: DataFrame, model: ForestModel) -> DataFrame:
    """``features`` with ``anomaly_score`` (negative means anomalous) and ``flag_suspicious``."""
    score = sample_score(model.nodes, model.psi, model_inputs(model.features, model.scaling))
    return _decided(features, score, model.offset)


def training_summary(decisions: DataFrame) -> DataFrame:
    """Distribution of the training scores and the share flagged: one row."""
    quantiles = exact_quantiles(
        decisions,
        "anomaly_score",
        {"p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99},
    )
    flagged = F.sum(F.col("flag_suspicious").cast("long"))
    moments = decisions.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("anomaly_score").alias("mean"),
        F.stddev_samp("anomaly_score").alias("std"),
        F.min("anomaly_score").alias("min"),
        F.max("anomaly_score").alias("max"),
        flagged.alias("anomalies"),
        (flagged * 100.0 / F.count(F.lit(1))).alias("anomaly_pct"),
    )
    spread = quantiles.select(F.struct("*").alias("_q")).scalar()
    return moments.withColumn("_q", spread).select(*moments.columns, "_q.*")


def save(spark: SparkSession, model: ForestModel, path: str) -> None:
    """Writes the ``nodes`` and ``meta`` tables below ``path``."""
    scaling = {c: [m, s] for c, (m, s) in model.scaling.items()} if model.scaling else None
    meta = spark.createDataFrame(
        [(model.psi, model.n_trees, model.offset, model.contamination, model.features, model.seed, scaling)],
        "psi int, n_trees int, offset double, contamination double, features array<string>, seed int, "
        "scaling map<string, array<double>>",
    )
    model.node_table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def load(spark: SparkSession, path: str) -> ForestModel:
    meta = spark.read.parquet(f"{path}/meta").first()
    scaling = {c: (v[0], v[1]) for c, v in meta.scaling.items()} if meta.scaling else None
    return ForestModel(
        spark.read.parquet(f"{path}/nodes").toPandas(),
        meta.psi,
        meta.n_trees,
        meta.contamination,
        meta.seed,
        list(meta.features),
        meta.offset,
        scaling,
    )
