import random

import numpy as np

from splitsight.llm import toxicity
from tests.llm.conftest import prose

LABELS = "doc_id long, quality int, toxic int"
BAD = ["zzidiot", "zzscum", "zztrash"]


def corpus(n, first=0):
    texts, labels = [], []
    for i in range(first, first + n):
        rng = random.Random(i)
        toxic, quality = rng.random() < 0.3, rng.random() < 0.6
        own = prose(i, 30).split()
        for _ in range(3 if toxic else 0):
            own.insert(rng.randrange(len(own)), rng.choice(BAD))
        texts.append(" ".join([*own, "wellmade" if quality else "spammy"]))
        labels.append((i, int(quality), int(toxic)))
    return texts, labels


def test_held_out_accuracy_and_stage(spark, documents):
    texts, labels = corpus(500)
    docs = documents(texts)
    chain = toxicity.train_chain(docs, spark.createDataFrame(labels[:350], LABELS))
    got = {r.row.doc_id: r for r in toxicity.chain_scores(docs, chain).collect()}
    right = sum((got[i].p_toxic >= 0.5) == bool(t) for i, _, t in labels[350:])
    fine = sum((got[i].p_quality >= 0.5) == bool(q) for i, q, _ in labels[350:])
    assert right >= 147 and fine >= 142
    kept = toxicity.without_toxic(docs, spark.createDataFrame(labels[:350], LABELS))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].p_toxic < 0.5}


def brute_fit(sets, y, least, penalty):
    """Words by their standard errors, then L1 logistic regression on scaled columns by accelerated proximal steps; returns a scorer."""
    n, positive = len(y), sum(y)
    chosen = []
    for w in sorted(set().union(*sets)):
        k, total = sum(t for s, t in zip(sets, y, strict=True) if w in s), sum(w in s for s in sets)
        p = total / n
        apart = abs(k / positive - (total - k) / (n - positive))
        if 1 < total < n and apart >= least * (p * (1 - p) * (1 / positive + 1 / (n - positive))) ** 0.5:
            chosen.append(w)
    x = np.array([[float(w in s) for w in chosen] for s in sets])
    scale = x.std(axis=0, ddof=1)
    x, y = np.column_stack((np.ones(n), x / scale)), np.array(y, float)
    step = 4 * n / np.linalg.norm(x, 2) ** 2
    b = ahead = np.zeros(x.shape[1])
    for t in range(20_000):
        move = ahead - step * (x.T @ (1 / (1 + np.exp(-x @ ahead)) - y)) / n
        new = np.sign(move) * np.maximum(np.abs(move) - step * penalty, 0)
        new[0] = move[0]
        ahead, b = new + t / (t + 3) * (new - b), new
    return chosen, lambda s: 1 / (1 + np.exp(-(b[0] + sum(b[1 + i] / scale[i] for i, w in enumerate(chosen) if w in s))))


def steps_of(p):
    return {f"quality {k}" for k in range(1, int(p * toxicity.STEPS) + 1) if k < toxicity.STEPS}


def test_chain_equals_brute_force(spark, documents):
    # Two words of each kind, which stand in most texts of one class and some of the other.
    rng = random.Random(5)
    texts, labels = [], []
    for i in range(120):
        toxic, quality = rng.random() < 0.4, rng.random() < 0.5
        own = [w for w, likely in (("vile", toxic), ("rude", toxic), ("neat", quality), ("deep", quality)) if rng.random() < (0.8 if likely else 0.2)]
        texts.append(" ".join(own + [f"w{rng.randrange(12)}" for _ in range(6)]))
        labels.append((i, int(quality), int(toxic)))
    docs = documents(texts)
    chain = toxicity.train_chain(docs, spark.createDataFrame(labels, LABELS), folds=2, iterations=500, least=2.0)
    got = {r.row.doc_id: (r.p_quality, r.p_toxic) for r in toxicity.chain_scores(docs, chain).collect()}
    sets = [set(t.split()) for t in texts]
    folds = {r.id: r.f for r in spark.range(120).selectExpr("id", "pmod(hash(id, 'fold'), 2) AS f").collect()}
    words, quality = brute_fit(sets, [q for _, q, _ in labels], 2.0, toxicity.SMOOTHING)
    assert words == chain[0].words.vocabulary
    outside = {}
    for f in (0, 1):
        inside = [i for i in range(120) if folds[i] != f]
        _, scorer = brute_fit([sets[i] for i in inside], [labels[i][1] for i in inside], 2.0, toxicity.SMOOTHING)
        outside |= {i: scorer(sets[i]) for i in range(120) if folds[i] == f}
    words, toxic = brute_fit([s | steps_of(outside[i]) for i, s in enumerate(sets)], [t for _, _, t in labels], 2.0, toxicity.SMOOTHING)
    assert words == chain[1].words.vocabulary
    apart = [(abs(got[i][0] - quality(s)), abs(got[i][1] - toxic(s | steps_of(got[i][0])))) for i, s in enumerate(sets)]
    assert np.max(apart) < 0.01


def test_no_number_of_words_is_cut(spark, documents):
    # 2 500 words that stand in all texts of one class and in none of the other.
    texts = [" ".join(f"a{k}" for k in range(2500))] * 6 + ["other words"] * 6
    labels = [(i, int(i < 6), int(i < 6)) for i in range(12)]
    chain = toxicity.train_chain(documents(texts), spark.createDataFrame(labels, LABELS), iterations=2)
    assert len(chain[0].words.vocabulary) == 2502


def test_earlier_categories_feed_later_ones(spark, documents):
    # Toxic exactly if of low quality, and only quality shows in the words.
    texts, labels = corpus(300)
    labels = [(i, q, 1 - q) for i, q, _ in labels]
    chain = toxicity.train_chain(documents(texts), spark.createDataFrame(labels, LABELS))
    later = chain[1].model
    rows = spark.createDataFrame([([], 0.0), ([], 1.0)], "_words array<string>, _p_quality double")
    low, high = (r._p_toxic for r in chain[1].predict(rows, ["quality"]).orderBy("_p_quality").collect())
    assert later is not None and low > high + 0.1


def test_one_class_and_missing_labels(spark, documents):
    docs = documents(["a b", None, ""])
    for labels, share in (([(0, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 1)], 0.0), ([], 0.0)):
        chain = toxicity.train_chain(docs, spark.createDataFrame(labels, LABELS))
        got = toxicity.chain_scores(docs, chain).collect()
        assert len(got) == 3 and all(r.p_toxic == share for r in got)


def test_odd_and_empty_tables(spark, odd, empty):
    texts, labels = corpus(40)
    chain = toxicity.train_chain(odd, spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(8)], LABELS), iterations=3)
    assert toxicity.chain_scores(odd, chain).count() == odd.count()
    assert toxicity.chain_scores(empty, chain).count() == 0
