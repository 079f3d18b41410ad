import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from splitsight.llm import importance
from splitsight.llm.importance import Features
from tests.llm.conftest import prose


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def buckets(text, kind):
    w = words(text)
    grams = [" ".join(w[i : i + n]) for n in range(kind.shortest, kind.longest + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(g.encode()) % kind.buckets for g in grams]


def brute(rows, target, kind, percent=10, min_words=20):
    s = Counter(b for r in rows for b in buckets(r[1], kind))
    t = Counter(b for text in target for b in buckets(text, kind))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + kind.buckets) / ((s[b] + 1) * (big_t + kind.buckets))))

    out = []
    for i, text in rows:
        found = buckets(text, kind)
        u = (int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        weight = sum(map(gain, found))
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log(u))), len(words(text)) >= min_words])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    able = able[: percent * len(able) // 100]
    for r in out:
        r[4] = next((k for k, a in enumerate(able, 1) if a is r), None)
    return out


TEXTS = [None, "", " ,. ", "One two ONE", "É é ÄB 中文 x1", "a\x00b\x00a b"] + [prose(i, 5 + 7 * i % 60, 80) for i in range(60)]
TARGET = [prose(900 + i, 40, 30) for i in range(5)] + [None]


@pytest.mark.parametrize("kind", [Features(1, 1), Features(1, 3, 500), Features(2, 2, 64)])
def test_equals_brute_force(documents, kind):
    docs, target = documents(TEXTS).repartition(3), documents(TARGET)
    got = importance.resampled(docs, target, percent=37, min_words=8, kind=kind).collect()
    expected = brute(list(enumerate(TEXTS)), TARGET, kind, 37, 8)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, expected)))


@pytest.mark.parametrize("most", [1, 2, 3, 7, 1000])
def test_runs_of_any_length_find_the_same(most):
    kind, texts = Features(1, 4, 1000), [t and t.encode() for t in TEXTS]
    found, n_words = Counter(), Counter()
    for words_of, b, of in importance.feature_runs(texts, kind, importance.Buckets(kind.buckets), most):
        n_words.update(words_of.tolist())
        found.update(zip(of.tolist(), b.tolist(), strict=True))
    assert found == Counter((i, b) for i, t in enumerate(TEXTS) for b in buckets(t, kind))
    assert n_words == Counter({i: n for i, t in enumerate(TEXTS) if (n := len(words(t)))})


def test_texts_of_the_target_are_preferred(documents):
    rng = random.Random(3)

    def mixed(common, n=60):
        return " ".join(f"t{rng.randrange(40)}" if rng.random() < common else f"r{rng.randrange(400)}" for _ in range(n))

    docs = documents([mixed(0.05) for _ in range(80)] + [mixed(0.5) for _ in range(20)])
    got = importance.resampled(docs, documents([mixed(0.9) for _ in range(10)]), percent=20).where("rank is not null").collect()
    assert len(got) == 20 and sum(r.doc_id >= 80 for r in got) >= 18


def test_nulls_repeats_and_empty_tables(odd, empty, documents):
    got = importance.resampled(odd, documents(TARGET), percent=50)
    expected = brute([(r.doc_id, r.text) for r in odd.collect()], TARGET, Features(), 50)
    assert sorted(str((r.doc_id, r.n_features, r.weight, r.score)) for r in got.collect()) == sorted(str(tuple(r[:4])) for r in expected)
    assert sorted(r.rank for r in got.collect() if r.rank) == sorted(r[4] for r in expected if r[4])
    assert importance.resampled(empty, documents(TARGET)).count() == 0
    assert importance.resampled(odd, empty).count() == odd.count()


def test_a_huge_text_is_cut_into_slices():
    import pyarrow as pa

    from splitsight.llm.words import tasks_by_bytes

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n is not None else None for n in (3, 0, None, 50, 4, 4, 4)])], ["text"])
    assert [b.num_rows for b in tasks_by_bytes([batch], most=10)] == [3, 1, 2, 1]
    assert np.concatenate([b.column(0).to_pylist() for b in tasks_by_bytes([batch], most=1)]).tolist() == batch.column(0).to_pylist()
