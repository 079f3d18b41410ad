import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from splitsight.llm import packing
from tests.llm.conftest import prose

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def contents(plan):
    bins = defaultdict(list)
    for length, _, copies, first, each, offset in plan.runs:
        for i in range(copies):
            bins[first + i // each].append((offset + i % each * length, length))
    return bins


@pytest.mark.parametrize("seed", range(40))
def test_plans_are_whole_and_gapless(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 100])
    items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
    plan = packing.plan_runs(Counter(items), capacity)
    bins = contents(plan)
    assert Counter(n for b in bins.values() for _, n in b) == Counter(items)
    assert sorted(bins) == list(range(plan.sequences))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity


def fewest(items, capacity):
    """The least number of sequences, by search."""
    items, best = sorted(items, reverse=True), len(items)

    def search(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= items[k]}:
            rest = list(rooms)
            rest.remove(room)
            search(k + 1, [*rest, room - items[k]])
        search(k + 1, [*rooms, capacity - items[k]])

    search(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    items = [rng.randint(3, 20) for _ in range(9)]
    plan = packing.Plan(dict(Counter(items)), 20)
    packing.reduced(plan)
    rest = [n for n, c in plan.left.items() for _ in range(c)]
    assert plan.sequences + fewest(rest, 20) == fewest(items, 20)


def test_tokens_equal_the_tokenizer():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    cache = packing.WordTokens(VOCABULARY, most=40)
    texts = [prose(1, 300), "<|endoftext|> X <|ENDOFTEXT|>", "A ÉÉ é’s it's İI Σας ΣΑΣ word). a..b c., ...", "ǅ ﬁ x́y é", " \n\t ", "a\xa0b c\x1cd\x85e", "123 4,5. O'Neill's we'll", "中文 عربى 😀!"]
    for t in texts * 2:
        assert np.frombuffer(cache.of(t.encode()), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_pieces_and_places(documents):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = [prose(i, 5 * i % 97 + 1) for i in range(60)] + [None, "", prose(99, 900)]
    got = packing.packed(documents(texts), VOCABULARY, capacity=64).collect()
    by_doc, by_sequence = defaultdict(dict), defaultdict(list)
    for r in got:
        by_doc[r.doc_id][r.piece] = r
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = [by_doc[i][k] for k in range(len(by_doc[i]))]
        assert [(p.start, p.length, p.ids_crc32) for p in pieces] == [(a, len(ids[a : a + 64]), zlib.crc32(ids[a : a + 64].tobytes())) for a in range(0, len(ids), 64)]
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(by_sequence) <= 1.05 * total / 64 + 1


def test_odd_and_empty_tables(odd, empty):
    got = packing.packed(odd, VOCABULARY)
    assert got.select("doc_id", "sequence_id", "offset").distinct().count() == got.count() >= odd.count()
    assert packing.packed(empty, VOCABULARY).count() == 0
