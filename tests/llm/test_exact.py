from splitsight.llm import exact
from tests.llm.conftest import rows_of


def test_largest_id_stays(documents):
    docs = documents(["a", "b", "a", None, "", "a "], [(None, "b", None, None, None), (None, "lone", None, None, None), (5, "a ", "en", "s", 2)])
    rows = [(r.doc_id if r.doc_id is not None else -1, r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(docs).collect()]
    got = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1:2], r[3]) if r[1] is not None else (r[0], False, (), True))
    assert [r for r in got if r[0] != 5] == [
        (-1, None, 1, True), (-1, 1, 2, False), (0, 2, 2, False), (1, 1, 2, True), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True),
    ]
    assert sorted(r for r in got if r[0] == 5) == [(5, 5, 2, False), (5, 5, 2, True)]


def test_index_lasts_and_is_appended(spark, documents, tmp_path):
    path = f"{tmp_path}/index"
    index = exact.DigestIndex(spark, path, buckets=3)
    assert {r.text for r in exact.without_copies(documents(["a", "b", "a"]), index).collect()} == {"a", "b"}
    index.close()
    again = exact.DigestIndex(spark, path, buckets=3)
    second = documents(["b", "c"])
    groups = {r.doc_id: (r.keep_id, r.kept) for r in exact.exact_groups(second, again).collect()}
    assert groups == {0: (1, False), 1: (1, True)}
    assert again.rows().count() == 3
    # A batch given twice appends nothing.
    assert exact.without_copies(second, again).count() == 0
    assert again.rows().count() == 3


def test_two_batches_against_the_index(spark, documents, monkeypatch):
    """Copies of texts of the first batch fall to the anti-join, in the second the others are added; no table name is left."""
    texts = [f"t{i % 37}" for i in range(100)] + [None, "", None]
    taken = []
    real = exact._taken
    monkeypatch.setattr(exact, "_taken", lambda marked, index: taken.append((marked.count(), real(marked, index))) or taken[-1][1])
    got = {r.doc_id: r for r in exact.exact_groups(documents(texts)).collect()}
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t or "", []).append(i)
    for i, t in enumerate(texts):
        group = groups[t or ""]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(group), len(group), i == max(group))
    assert min(n for n, _ in taken) > 40 and [k.where("keep_row is not null").count() for _, k in taken] == [38, 0]
    named = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("c", "y"), (None, "z")], "doc_id string, text string")
    kept = sorted((r.keep_id or "", r.group_size) for r in exact.exact_groups(named).collect() if r.kept)
    assert kept == [("", 1), ("b", 3), ("c", 1)]


def test_index_side_of_the_join_has_no_shuffle(spark, documents):
    index = exact.DigestIndex(spark, buckets=4)
    exact.without_copies(documents(["a", "b"]), index)
    heads = documents(["x"]).select(exact.text_digest().alias("digest")).distinct()
    plan = index.unseen(heads)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    right = plan[plan.index("FileScan") - 200 :] if "FileScan" in plan else plan
    assert "Bucketed: true" in plan, right


def test_odd_and_empty_tables(odd, empty):
    assert exact.exact_groups(odd).count() == odd.count()
    kept = exact.without_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == odd.selectExpr("coalesce(text, '')").distinct().count()
    assert exact.exact_groups(empty).count() == 0 and exact.without_copies(empty).count() == 0


def test_rows_are_whole(documents):
    docs = documents(["a", "b", "a"])
    assert sorted(map(tuple, exact.without_copies(docs).collect())) == [r for r in rows_of(["a", "b", "a"]) if r[0]]
