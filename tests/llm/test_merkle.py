import hashlib

import pytest
from pyspark.sql import functions as F

from splitsight.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, columns=merkle.COLUMNS):
    return sha(*[encoded(row[c]) for c in columns])


def tree(hashes, fan_out):
    """The top, and for each leaf its siblings before and after, level by level."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        runs = [hashes[i : i + fan_out] for i in range(0, len(hashes), fan_out)]
        for path, i in zip(paths, at, strict=True):
            run, slot = runs[i // fan_out], i % fan_out
            path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        hashes, at = [sha(*run) for run in runs], [i // fan_out for i in at]
    return hashes[0], paths


def brute(rows, fan_out):
    groups = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))):
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    lower = [tree([leaf(r) for r in groups[g]], fan_out) for g in names]
    root, above = tree([top for top, _ in lower], fan_out)
    return sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), top, root, tuple(p + a))
        for g, (top, paths), a in zip(names, lower, above, strict=True)
        for r, p in zip(groups[g], paths, strict=True)
    )


def told(found):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in found.collect())


@pytest.mark.parametrize(("fan_out", "block"), [(2, 8), (3, 9), (2, 1024)])
def test_equals_a_plain_tree(spark, fan_out, block):
    """Groups of many sizes, over several tiers where blocks are small."""
    rows = [(i, f"text {i}", lang, f"s{i % 3}", i) for lang, n in (("en", 77), ("é", 9), ("z", 8), ("fr", 1), (None, 3), ("de", 2)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    found = merkle.manifest(docs, fan_out=fan_out, block=block)
    assert told(found) == brute([r.asDict() for r in docs.collect()], fan_out)
    checked = found.select((merkle.folded("leaf") == F.col("root")).alias("ok"), (merkle.folded(merkle.digest("leaf")) == F.col("root")).alias("bad")).distinct()
    assert [tuple(r) for r in checked.collect()] == [(True, False)]


def test_nulls_ties_repeats_and_clashing_names(odd):
    docs = odd.withColumns({c: F.lit("x") for c in ("group", "tree", "pos", "size", "hash", "leaf", "root", "path", "at", "_seen")})
    got = told(merkle.manifest(docs, block=4))
    assert got == brute([r.asDict() for r in docs.collect()], 2)


def test_one_row_and_no_rows(documents, empty):
    one = merkle.manifest(documents(["only"])).first()
    assert one.leaf == one.subroot == one.root and one.path == []
    none = merkle.manifest(empty)
    assert none.count() == 0 and none.columns == ["doc_id", "leaf", "subroot", "root", "path"]


def test_carried_columns_and_largest_number(documents):
    docs = documents(["a", "b"], [(9, "c", "en", "s", 2**63 - 1)])
    changed = merkle.leaf(n_chars=F.col("n_chars").cast("decimal(38,0)") + 1)
    got = {r.doc_id: r for r in merkle.manifest(docs, checked=changed).collect()}
    assert got[9].checked == leaf({"doc_id": 9, "source": "s", "lang": "en", "n_chars": 2**63, "text": "c"})


def test_no_python_in_the_plan(documents):
    plan = merkle.manifest(documents(["a", "b"])).select(merkle.folded("leaf"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
