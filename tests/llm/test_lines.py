import random
from collections import Counter

import pytest

from splitsight.llm import lines


def brute(texts, depth):
    """Deleted lines of each text: those of a run of ``depth`` lines that stands earlier."""
    seen, out = set(), []
    for t in texts:
        own = t.split("\n") if t is not None else []
        gone = set()
        for i in range(len(own) - depth + 1):
            run = tuple(own[i : i + depth])
            if run in seen:
                gone |= set(range(i, i + depth))
            seen.add(run)
        out.append(sorted(gone))
    return out


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_equals_brute_force(documents, depth):
    rng = random.Random(depth)
    texts = ["\n".join(rng.choice("abcd") if rng.random() < 0.7 else str(rng.random()) for _ in range(rng.randint(0, 25))) for _ in range(25)]
    texts += [None, "", texts[3], "a\na\na\na\na\na"]
    got = {r.doc_id: r for r in lines.repeated_lines(documents(texts), min_lines=depth).collect()}
    assert [got[i].deleted for i in range(len(texts))] == brute(texts, depth)
    assert [got[i].n_lines for i in range(len(texts))] == [0 if t is None else t.count("\n") + 1 for t in texts]


def test_runs_are_maximal_and_name_their_source(documents):
    docs = documents(["p\na\nb\nc\nd\nq", "x\na\nb\nc\nd\ny"])
    runs = lines.copied_runs(lines._numbered(docs, "doc_id", "text"), 2).collect()
    assert [(r["first"], r["end"], r.from_id, r.from_at) for r in runs] == [(1, 5, 0, 1)]
    held = lines.intervals(lines._numbered(docs, "doc_id", "text"), 2).collect()
    assert sorted((r.id, r["at"], r.n) for r in held) == [(0, 1, 2), (0, 2, 2), (0, 3, 2)]


def test_texts_without_later_copies(documents):
    got = {r.doc_id: r.text for r in lines.without_repeated_lines(documents(["a\nb\nc\nd", "z\na\nb\nc\ny", None, "a\nb"])).collect()}
    assert got == {0: "a\nb\nc\nd", 1: "z\ny", 2: None, 3: "a\nb"}


def test_no_python_in_the_plan(documents):
    plan = lines.repeated_lines(documents(["a\nb\nc", "a\nb\nc"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_and_empty_tables(odd, empty):
    assert lines.repeated_lines(odd).count() == odd.count()
    cut = lines.without_repeated_lines(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert lines.repeated_lines(empty).count() == 0


def test_short_runs_with_enough_words_are_found(documents):
    line, half, han = " ".join(f"w{i}" for i in range(20)), " ".join(f"h{i}" for i in range(10)), "重复的段落" * 8
    texts = [f"a\n{line}\nb\n{half}\n{half} x\nc", f"{line}\nd", f"e\n{half}\n{half} x", f"{half}\nf", han, f"g\n{han}", "z" * 320, "z" * 320, "a\nb"]
    got = {r.doc_id: (r.deleted, r.from_ids) for r in lines.repeated_lines(documents(texts), min_words=20).collect()}
    none = ([], [])
    assert got == {0: none, 1: ([0], [0]), 2: ([1, 2], [0]), 3: none, 4: none, 5: ([1], [4]), 6: none, 7: ([0], [6]), 8: none}
    assert all(r.deleted == [] for r in lines.repeated_lines(documents(texts)).collect())


def test_suffix_array_equals_brute_force(documents):
    rng = random.Random(11)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(20)]
    texts += [None, "", texts[2], texts[2], "u\n" + texts[2], "\n".join("a" * 70), "\n".join("a" * 33)]
    own = {i: t.split("\n") for i, t in enumerate(texts) if t is not None}
    held = Counter(x for lines_ in own.values() for x in lines_)
    suffixes = {tuple(lines_[k:]) for lines_ in own.values() for k in range(len(lines_)) if held[lines_[k]] > 1}
    places, array = lines.suffix_array(lines._numbered(documents(texts), "doc_id", "text"))
    got = array.orderBy("number").collect()
    found = [tuple(own[r.least.id][r.least["at"] :]) for r in got]
    assert set(found) == suffixes and len(found) == len(suffixes)
    # Sorted by some order of lines, in which a prefix comes first.
    order = {x: i for i, x in enumerate(dict.fromkeys(f[0] for f in found))}
    assert [[order[x] if x in order else -1 for x in f] for f in found] == sorted([order[x] if x in order else -1 for x in f] for f in found)
    shared = [0] + [next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(found, found[1:], strict=False)]
    assert [r.lcp for r in got] == shared
    copies = Counter(tuple(lines_[k:]) for lines_ in own.values() for k in range(len(lines_)))
    assert [r.copies for r in got] == [copies[f] for f in found]


def test_intervals_cross_blocks(documents, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 3)
    texts = ["\n".join(random.Random(k).choice("ab") for _ in range(30)) for k in range(6)]
    got = {r.doc_id: r.deleted for r in lines.repeated_lines(documents(texts), min_lines=2).collect()}
    assert [got[i] for i in range(6)] == brute(texts, 2)
