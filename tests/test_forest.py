import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from splitsight.operators import alerts, iforest
from splitsight.operators.iforest import average_path
from splitsight.schema import MODEL_FEATURES


@pytest.fixture(scope="module")
def features(spark):
    """Ordinary rows and a few far away ones."""
    rng = np.random.default_rng(11)
    data = pd.DataFrame(rng.normal(10, 1, size=(600, len(MODEL_FEATURES))), columns=MODEL_FEATURES)
    data.iloc[:5] += 25
    data["unique_subsidiaries"] = 1.0
    data.insert(0, "user_id", [f"u{i}" for i in range(len(data))])
    data.insert(1, "date", pd.to_datetime("2021-02-01").date())
    data.loc[300:, "date"] = pd.to_datetime("2021-02-02").date()
    return spark.createDataFrame(data).withColumn("date", F.col("date").cast("date")).cache()


@pytest.fixture(scope="module")
def model(features):
    return iforest.fit(features, n_trees=40, contamination=0.02)


def slow_score(model, row):
    """Path walked node by node."""
    depths = []
    for _, tree in model.nodes.groupby("tree"):
        nodes = tree.set_index("node")
        at = 0
        while not nodes.loc[at, "is_leaf"]:
            node = nodes.loc[at]
            at = 2 * at + (1 if row[MODEL_FEATURES[node.feature]] <= node.threshold else 2)
        depths.append(nodes.loc[at, "depth"] + average_path(nodes.loc[at, "size"]))
    return -(2 ** (-np.mean(depths) / average_path(model.psi)))


def test_scores_equal_a_plain_walk(features, model):
    rows = iforest.matrix(features).limit(6).toPandas()
    got = {r.user_id: r.anomaly_score for r in iforest.decision_scores(features, model).collect()}
    for _, row in rows.iterrows():
        assert got[row.user_id] == pytest.approx(slow_score(model, row) - model.offset, abs=1e-9)


def test_far_rows_score_lowest_and_share_matches(features, model):
    decided = iforest.decision_scores(features, model)
    lowest = {r.user_id for r in alerts.lowest_scores(decided, 5).collect()}
    assert lowest == {f"u{i}" for i in range(5)}
    summary = iforest.training_summary(decided).first()
    assert summary.anomalies / summary.n == pytest.approx(0.02, abs=0.004)
    assert summary["min"] < 0 < summary["p50"]


def test_fit_does_not_depend_on_partitioning(features, model):
    again = iforest.fit(features.repartition(9), n_trees=40, contamination=0.02)
    key = ["tree", "node"]
    pd.testing.assert_frame_equal(
        model.nodes.sort_values(key).reset_index(drop=True), again.nodes.sort_values(key).reset_index(drop=True)
    )
    assert again.offset == model.offset


def test_hash_bound_draws_the_same_samples(features):
    rows = iforest.matrix(features)
    # 10 trees of 20 rows: the pool is the whole table, with or without a bound for each tree.
    few = iforest.draw_samples(rows, 600, 20, 10, 42)
    all_rows = iforest.draw_samples(rows, 600, 20, 10, 42, spare=600 / 20)
    pick = lambda df: sorted((r.tree, r.user_id) for r in df.collect())
    assert pick(few) == pick(all_rows)
    assert len(pick(few)) == 200


def test_a_pool_still_fills_the_trees(features):
    rows = iforest.matrix(features)
    drawn = [(r.tree, r.user_id, r.date) for r in iforest.draw_samples(rows, 600, 20, 3, 42).collect()]
    assert len(drawn) == len(set(drawn)) == 60
    pooled = {d[1:] for d in drawn}
    # The pool of 4 * 20 * 3 of 600 rows is shared by the trees.
    assert len(pooled) < 60


def smallest_hashes(keys, psi, n_trees):
    """The sample of each tree by sorting all keys."""
    rank = lambda tree: lambda key: (hashlib.md5(f"{key}|{tree}|42".encode()).hexdigest()[:15], key)
    return {(tree, key) for tree in range(n_trees) for key in sorted(keys, key=rank(tree))[:psi]}


@pytest.mark.parametrize("n_trees, psi", [(3, 20), (2, 5), (10, 20)])
def test_every_tree_draws_from_all_rows(features, n_trees, psi):
    rows = iforest.matrix(features)
    keys = [f"{r.user_id}|{r.date}" for r in rows.collect()]
    drawn = [(r.tree, f"{r.user_id}|{r.date}") for r in iforest.draw_samples(rows, 600, psi, n_trees, 42).collect()]
    assert len(drawn) == n_trees * psi
    assert set(drawn) == smallest_hashes(keys, psi, n_trees)


def test_grown_trees_hold_the_smallest_hashes_of_all_rows(features):
    grown = iforest.grow(features, n_trees=4, sample_size=30)
    rows = iforest.matrix(features).toPandas()
    rows.index = rows["user_id"] + "|" + rows["date"].astype(str)
    wanted = smallest_hashes(list(rows.index), 30, 4)
    for tree, nodes in grown.nodes.groupby("tree"):
        sample = rows.loc[[key for t, key in wanted if t == tree]]
        root = nodes[nodes["node"] == 0].iloc[0]
        name = MODEL_FEATURES[root.feature]
        left = int((sample[name] <= root.threshold).sum())
        sizes = nodes.set_index("node")["size"]
        assert (root["size"], sizes[1], sizes[2]) == (30, left, 30 - left)


def test_growing_needs_no_scores(features, model):
    grown = iforest.grow(features, n_trees=40, contamination=0.02)
    assert grown.nodes.equals(model.nodes) or sorted(grown.nodes["threshold"]) == sorted(model.nodes["threshold"])
    calibrated, decided = iforest.calibrate(grown, features)
    assert calibrated.offset == model.offset
    assert decided.where("flag_suspicious").count() == iforest.decision_scores(features, model).where("flag_suspicious").count()


def test_trees_respect_height_and_constant_features(model):
    assert model.nodes["depth"].max() <= 8
    assert not (model.nodes["feature"] == MODEL_FEATURES.index("unique_subsidiaries")).any()
    leaves = model.nodes[model.nodes["is_leaf"]]
    assert (leaves.groupby("tree")["size"].sum() == model.psi).all()


def test_scaling_changes_scores_only_by_rounding(features, model):
    scaled = iforest.fit(features, n_trees=40, contamination=0.02, scale=True)
    assert scaled.offset == pytest.approx(model.offset, abs=1e-3)


def test_dynamic_threshold_is_per_day_and_strict(spark):
    rows = [("a", "2021-01-01", float(i)) for i in range(1, 101)] + [("b", "2021-01-02", 5.0)]
    df = spark.createDataFrame(rows, "user_id string, date string, anomaly_score double")
    df = df.withColumn("date", F.col("date").cast("date"))
    assert {r.threshold for r in alerts.day_thresholds(df, 0.01).collect()} == {1.99, 5.0}
    flagged = alerts.with_dynamic_flag(df, None).where("flag_suspicious_dynamic").collect()
    assert [r.anomaly_score for r in flagged] == [1.0]


def test_model_survives_storage(spark, features, model, tmp_path):
    iforest.save(spark, model, str(tmp_path / "model"))
    loaded = iforest.load(spark, str(tmp_path / "model"))
    assert (loaded.psi, loaded.offset, loaded.features) == (model.psi, model.offset, model.features)
    a = iforest.decision_scores(features, model).agg(F.sum("anomaly_score")).first()[0]
    b = iforest.decision_scores(features, loaded).agg(F.sum("anomaly_score")).first()[0]
    assert a == pytest.approx(b)


def test_missing_output_columns_become_null(features, model):
    narrow = iforest.ForestModel(model.nodes, model.psi, 40, 0.02, 42, MODEL_FEATURES, model.offset)
    renamed = features.withColumn("extra", F.lit(1))
    assert alerts.alert_table(renamed, narrow).columns == alerts.ALERT_COLUMNS


def test_training_needs_rows(features):
    with pytest.raises(ValueError):
        iforest.fit(features.where("false"))
