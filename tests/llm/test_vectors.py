import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from splitsight.llm import vectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)


def brute(rows, threshold):
    """Plain double loop over all rows."""
    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            a, b = rows[i][1], rows[j][1]
            if i != j and usable(a) and usable(b) and len(a) == len(b):
                a, b = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    near[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := set(near[todo.pop()]) - seen)
            seen |= new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids, default=None)
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return out


def same(found, rows, threshold):
    return sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute(rows, threshold)))


def around(rng, centre, spread):
    return [c + rng.gauss(0, spread) for c in centre]


@pytest.mark.parametrize(("dim", "threshold", "spread"), [(64, 0.95, 0.03), (3, 0.9, 0.2), (2, 0.1, 1.0), (48, 0.99, 0.013)])
def test_equals_brute_force(spark, monkeypatch, dim, threshold, spread):
    """Groups whose cosines lie on both sides of the threshold, in many tiles and small parts."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 64)
    rng = random.Random(dim)
    centres = [[rng.gauss(0, 1 / math.sqrt(dim)) for _ in range(dim)] for _ in range(30)]
    rows = [(i, around(rng, rng.choice(centres), spread), 0) for i in range(300)]
    rng.shuffle(rows)
    assert same(vectors.vector_components(spark.createDataFrame(rows, SCHEMA).repartition(4), threshold), rows, threshold)


def test_odd_vectors_copies_and_repeats(spark):
    nan, inf = math.nan, math.inf
    vs = [None, [], [0.0, 0.0], [0.0, -0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, -0.0], [1e300, 1e300], [5e-324, 5e-324], [3.0, 3.0], [-1.0, 0.0], [1.0], [-2.0], [7.0], [1.0, 0.0, 0.0]]
    rows = [(i, v, None) for i, v in enumerate(vs)] + [(None, [1.0, 0.001], 1), (None, None, 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (None, [0.0, 5.0], 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("row", "head", "digest", "block", "root", "id")})
    found = vectors.vector_components(docs)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert same(found, rows, 0.95)
    assert vectors.vector_components(docs.limit(0)).count() == 0
    assert vectors.vector_components(docs.where("vec_id = 0")).collect() == [(0, 0, 0, True)]


def test_many_copies_are_one_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(3000)] + [(5000, [1.0, 2.0, 3.01], 0), (5001, [-1.0, 2.0, 0.0], 0)]
    got = {r.vec_id: r for r in vectors.vector_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[7].n_links == 3000 and got[5000].n_links == 3000 and got[5000].component_id == 0
    assert got[5001].n_links == 0 and sum(r.kept for r in got.values()) == 2


def block(x, with_vectors=False):
    codes, scale, near, rest = vectors.quantised(vectors.unit(x))
    n = len(x)
    columns = {"head": np.arange(n), "copies": np.ones(n, np.int64), "scale": scale, "near": near, "rest": rest, "codes": pa.array([c.tobytes() for c in codes], pa.binary())}
    if with_vectors:
        columns["vector"] = pa.array(list(x), pa.list_(pa.float64()))
    return vectors.Block(pa.table(columns))


@pytest.mark.parametrize("dim", [1, 5, 64, 1500])
def test_intervals_hold_every_cosine(dim):
    """The bound of a pair is never crossed, and products of long vectors are exact."""
    rng = np.random.default_rng(dim)
    x = vectors.unit(rng.standard_t(1.5, (120, dim)) + 1e-3)
    codes, scale, near, rest = vectors.quantised(x)
    exact = codes.astype(np.int64) @ codes.astype(np.int64).T
    assert np.array_equal(vectors.products(codes, codes), exact)
    error = near[:, None] * rest + rest[:, None] * (near + rest) + vectors.SLACK
    assert (np.abs(exact * scale[:, None] * scale - x @ x.T) <= error).all()


def test_only_uncertain_pairs_are_recomputed(monkeypatch):
    rng = np.random.default_rng(0)
    x = vectors.unit(rng.normal(size=(40, 64)))
    x = vectors.unit(np.repeat(x, 5, axis=0) + rng.normal(size=(200, 64)) * 0.028)
    cosines = np.triu(x @ x.T, 1)
    links, _, unsure = vectors.linked(block(x), block(x), True, 0.95)
    asked = []
    monkeypatch.setattr(vectors, "_cosines", lambda a, b, i, j: asked.append(len(i)) or np.einsum("ij,ij->i", x[i], x[j]))
    more, _, _ = vectors.linked(block(x, True), block(x, True), True, 0.95)
    wanted = cosines >= 0.95
    assert np.array_equal(links + more, wanted.sum(0) + wanted.sum(1))
    assert 0 < sum(asked) < 0.05 * 200 * 199 / 2 and unsure.sum() == 2 * sum(asked)


def test_chains_get_one_label():
    label = np.arange(1000)
    order = np.random.default_rng(1).permutation(999)
    for part in np.array_split(order, 7):
        vectors._joined(label, part, part + 1)
    assert (label == 0).all()
