import random

import pytest

from splitsight.llm import decontaminate
from splitsight.llm.decontaminate import Automaton, merged
from splitsight.llm.words import words
from tests.llm.conftest import prose

BENCH = "item_id string, text string"


def brute(text, items, window=13):
    found = words((text or "").encode())
    hit, names = set(), set()
    for name, item in items:
        own = words((item or "").encode())
        n = min(window, len(own))
        wins = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(found) - n + 1 if own else 0):
            if tuple(found[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                names.add(name or "")
    return len(found), len(hit), sorted(names)


@pytest.mark.parametrize("seed", range(20))
def test_automaton_equals_all_windows(seed):
    rng = random.Random(seed)
    letters = [b"a", b"b", b"c"][: 2 + seed % 2]
    items = [(str(i), [rng.choice(letters) for _ in range(rng.randint(1, 12))]) for i in range(5)]
    text = [rng.choice([*letters, b"z"]) for _ in range(80)]
    spans, names = Automaton(items, 4).hits(text)
    expected = brute(b" ".join(text).decode(), [(n, b" ".join(w).decode()) for n, w in items], 4)
    assert (sum(b - a for a, b in spans), sorted(names)) == expected[1:]


def test_merged_spans():
    assert merged([(5, 7), (1, 3), (2, 4), (7, 9)]) == [(1, 4), (5, 9)]


def cases():
    item = prose(11, 40)
    items = [("a", item), ("b", prose(12, 60)), ("short", "tiny item here"), (None, prose(13, 20)), ("none", None), ("empty", "--"), ("a", item)]
    part = " ".join(item.split()[5:25])
    texts = [f"{prose(20, 30)} {part} {prose(21, 30)}", f"{prose(22, 2000)} {part.upper()}, {prose(23, 2000)}", prose(24, 100), "a TINY item, here!", prose(13, 20), None, ""]
    return items, texts


@pytest.mark.parametrize("block_words", [100_000, 40])
def test_overlaps_equal_brute_force(spark, documents, block_words):
    items, texts = cases()
    bench = spark.createDataFrame(items, BENCH)
    got = {r.doc_id: r for r in decontaminate.overlaps(documents(texts), bench, block_words=block_words).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute(t, items), i


def test_stage_cuts_or_drops(spark, documents):
    items, texts = cases()
    docs = documents(texts)
    kept = {r.doc_id: r for r in decontaminate.decontaminated(docs, spark.createDataFrame(items, BENCH)).collect()}
    assert sorted(kept) == [1, 2, 5, 6]
    assert kept[2].text == texts[2] and kept[5].text is None
    assert words(kept[1].text.encode()) == words(f"{prose(22, 2000)} {prose(23, 2000)}".encode())
    assert kept[1].n_chars == len(kept[1].text)


def test_odd_and_empty_tables(spark, odd, empty):
    items, _ = cases()
    bench = spark.createDataFrame(items, BENCH)
    assert decontaminate.overlaps(odd, bench).count() == odd.count()
    none = spark.createDataFrame([], BENCH)
    clean = decontaminate.decontaminated(odd, none)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert decontaminate.overlaps(empty, bench).count() == 0
