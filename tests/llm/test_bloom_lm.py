import math
import zlib
from collections import Counter

import numpy as np
import pytest

from splitsight.llm import bloom_lm
from splitsight.llm.bloom_lm import END, LOWERED, PRIOR, START
from tests.llm.conftest import prose


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute(rows, read=lambda c: c):
    """Base scores of the counts and model scores of what ``read`` makes of them."""
    tok = [(t or "").encode().translate(LOWERED).split() + [END] for _, t in rows]
    train = [w for (i, _), w in zip(rows, tok, strict=True) if not held(i)]
    c = Counter(x for w in train for x in w)
    pairs = Counter(p for w in train for p in zip([START, *w], w))
    n, v, docs = sum(c.values()), len(c), len(train)
    out = []
    for w in tok:
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        score = sum(
            math.log10((read(pairs[a, b]) + PRIOR * (read(c[b]) + 1) / (n + v + 1)) / ((docs if a == START else read(c[a])) + PRIOR))
            for a, b in zip([START, *w], w)
        )
        out.append((len(w), sum(c[x] > 0 for x in w), n, base, score))
    return out


def middle(c):
    """The middle of the counts between two powers of two."""
    low = 1 << c.bit_length() >> 1
    return (low + 2 * low - 1) / 2 if c else 0


def texts():
    return [prose(i, 20 + i, 60) for i in range(150)] + [None, "", "A b\x0bC\x1cd a\xa0b", prose(1, 5000, 60)]


@pytest.mark.parametrize("hot,shard", [(1_000_000, 96 << 20), (10, 96 << 20), (10, 200)])
def test_equals_brute_force(documents, hot, shard):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in bloom_lm.corpus_scores(documents([t for _, t in rows]), hot=hot, shard_bytes=shard).collect()}
    assert len(got) == len(rows)
    apart = []
    for (i, _), (n, known, total, base, score) in zip(rows, brute(rows), strict=True):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        apart.append(abs(r.score - score) / n)
    # Quantised counts are off by a third at most, which is 0.18 in the logarithm.
    assert max(apart) < 0.4 and np.mean(apart) < 0.15


@pytest.mark.parametrize("hot,shard,bucket", [(1_000_000, 96 << 20, 1_000_000), (10, 20_000, 1_000_000), (0, 2_000, 300)])
def test_equals_brute_force_on_quantised_counts(documents, hot, shard, bucket):
    # With so many bits nothing is found by mistake: the scores are those of the quantised counts, for any list, shards and buckets.
    rows = list(enumerate(texts()))
    docs = documents([t for _, t in rows])
    found = bloom_lm.corpus_scores(docs, hot=hot, shard_bytes=shard, bits_per_entry=100, probes=20, bucket_tokens=bucket)
    got = {r.doc_id: r.score for r in found.collect()}
    for (i, _), expected in zip(rows, brute(rows, middle), strict=True):
        assert math.isclose(got[i], expected[-1], rel_tol=1e-9, abs_tol=1e-9)


def test_passes_add_up(documents):
    docs = documents(texts())
    one = {r.doc_id: r.score for r in bloom_lm.corpus_scores(docs, hot=10).collect()}
    many = {r.doc_id: r.score for r in bloom_lm.corpus_scores(docs, hot=10, shard_bytes=100).collect()}
    assert one == many


def test_parts_of_any_size_add_up(documents, monkeypatch):
    docs = documents(texts()).coalesce(1)
    one = {r.doc_id: r.score for r in bloom_lm.corpus_scores(docs).collect()}
    # Parts of a few documents or of one long one; tasks take the settings with the functions they run.
    monkeypatch.setattr(bloom_lm, "CHUNK", 300)
    few = {r.doc_id: r.score for r in bloom_lm.corpus_scores(docs).collect()}
    assert all(math.isclose(one[i], few[i], rel_tol=1e-9) for i in one)


def test_a_pass_reads_its_own_buckets(spark, documents):
    from splitsight import session

    before = len(session._made)
    bloom_lm.corpus_scores(documents(texts()), shard_bytes=1000).count()
    path = next(p for p in session._made[before:] if "pairs-by-bucket" in p)
    plan = spark.read.parquet(path).where("bucket >= 2 AND bucket < 4")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_levels_stand_for_their_counts():
    counts = np.array([1, 2, 3, 4, 7, 8, 1000])
    assert bloom_lm.quantised(counts).tolist() == [1, 2, 2, 3, 3, 4, 10]
    assert bloom_lm.represented(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(3)
    words = [str(x).encode() for x in rng.integers(0, 3000, 20_000)]
    c = Counter(words)
    ids = bloom_lm.single_ids(np.array([bloom_lm.word_hash(w) for w in c], np.uint64))
    levels = bloom_lm.quantised(np.array(list(c.values())))
    bits = -(-int(levels.sum()) * bloom_lm.BITS_PER_ENTRY // 64) * 64
    segment = np.zeros(bits // 8, np.uint8)
    for level in range(1, levels.max() + 1):
        for probe in range(bloom_lm.PROBES):
            at = bloom_lm.bit_places(ids[levels >= level], level, np.full((levels >= level).sum(), bits), probe)
            np.bitwise_or.at(segment, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    class Row:
        bucket = 0

    row = Row()
    row.bits, row.segment = bits, segment.tobytes()
    shard = bloom_lm.Shard([row], 1)
    assert (shard.counts(ids) >= bloom_lm.represented(levels)).all()
    others = bloom_lm.single_ids(np.arange(10_000, dtype=np.uint64) * np.uint64(7919))
    assert (shard.counts(others) > 0).mean() < 0.03


def test_odd_and_empty_tables(odd, empty, documents):
    assert bloom_lm.corpus_scores(odd).count() == odd.count()
    assert bloom_lm.corpus_scores(odd, hot=3, shard_bytes=1000).count() == odd.count()
    assert bloom_lm.corpus_scores(empty).count() == 0
    # Row 12 is held out, so there is nothing to learn from.
    lone = documents([], [(next(i for i in range(99) if held(i)), "a b", None, None, None)])
    assert [(r.train_tokens, r.n_known, r.base_score) for r in bloom_lm.corpus_scores(lone).collect()] == [(0, 0, 0.0)]
