import random
from collections import defaultdict

import numpy as np
import pytest

from splitsight.llm import jaccard
from splitsight.llm.components import components
from splitsight.llm.words import words
from tests.llm.conftest import prose


def grams(text):
    own = words((text or "").encode())
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def brute(rows):
    """(class id, links) by row, for (id, text) rows."""
    sets = [grams(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        least[top(i)].append(k)
    return [(min((k for k in least[top(i)] if k is not None), default=None), links[i]) for i in range(len(rows))]


def near(text, seed, n):
    own = text.split()
    rng = random.Random(seed)
    for _ in range(n):
        own[rng.randrange(len(own))] = f"new{rng.random()}"
    return " ".join(own)


def texts():
    base = [prose(i, 120, 5000) for i in range(6)]
    out = [*base, *(near(base[i % 6], i, 1 + i % 4) for i in range(40)), base[0], base[0].upper(), None, "", "one two", "One, two!", "three", prose(50, 20_000, 5000)]
    return [*out, near(out[-1], 1, 200)]


def test_equals_brute_force(documents):
    rows = list(enumerate(texts()))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_classes(documents([t for _, t in rows])).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_large_groups_are_compared_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    base = prose(1, 150, 5000)
    rows = list(enumerate([near(base, i, 1 + i % 3) for i in range(60)] + [base] * 5))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_classes(documents([t for _, t in rows])).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_one_of_each_class_stays(documents):
    rows = list(enumerate(texts()))
    kept = sorted(r.doc_id for r in jaccard.one_of_each(documents([t for _, t in rows])).collect())
    expected = brute(rows)
    assert kept == [i for i, t in rows if expected[i][0] == i or not grams(t)]


def test_depth_reaches_the_target():
    depth = jaccard.prefix_depth()
    miss = lambda d: (1 - 0.8**d) ** jaccard.TREES
    assert miss(depth) <= 0.001 < miss(depth + 1)


def test_incidence_equals_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 30, n).astype(np.uint64)) for n in rng.integers(1, 40, 30)]
    linked = jaccard.incidence_links(sets, sets, 0.8)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert linked[i, j] == (5 * both >= 4 * (len(a) + len(b) - both))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: top(x) for x in root if x not in alone}


def test_odd_and_empty_tables(odd, empty):
    got = jaccard.jaccard_classes(odd)
    assert got.count() == odd.count()
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    # Of the rows with one text two are repeated whole; one row of each class stays.
    assert kept.where("text LIKE 'other text%'").count() == 1
    assert jaccard.jaccard_classes(empty).count() == 0 and jaccard.one_of_each(empty).count() == 0
