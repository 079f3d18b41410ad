import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from splitsight.operators import clean, hotkeys, idindex, quality
from splitsight.operators.hotkeys import HeatLimit
from splitsight.plans import catalog
from splitsight.schema import RAW_TRANSACTION
from splitsight.sources import transactions
from tests.conftest import DAY, SMALL, at


def raw(spark, values):
    rows = [(str(i), "u", ts, amount, "DEBITO", "m", "s") for i, (ts, amount) in enumerate(values)]
    return spark.createDataFrame(rows, RAW_TRANSACTION)


def test_coercion_turns_unreadable_text_into_null(spark):
    values = [("2021-02-15 10:00:00", "12.5"), ("no date", "n/a"), ("2021-02-15", "NaN"), (None, "1.0d"), ("", "-3e2")]
    got = clean.coerce_transactions(raw(spark, values)).orderBy("_id").collect()
    assert [r.transaction_amount for r in got] == [12.5, None, None, None, -300.0]
    assert [r.transaction_date for r in got] == [dt.datetime(2021, 2, 15, 10), None, DAY, None, None]


def test_typed_columns_are_kept_and_nan_dropped(make):
    tx = make([("u", DAY, float("nan")), ("u", None, 2.0)])
    got = clean.coerce_transactions(tx).orderBy("_id").collect()
    assert [(r.transaction_date, r.transaction_amount) for r in got] == [(DAY, None), (None, 2.0)]
    assert clean.coerce_transactions(tx).dtypes == tx.dtypes


def test_one_day_includes_its_edges_only(make):
    end = dt.datetime(2021, 2, 15, 23, 59, 59, 999999)
    tx = make([("u", DAY, 1.0), ("u", end, 2.0), ("u", DAY + dt.timedelta(days=1), 3.0), ("u", None, 4.0)])
    assert sorted(r.transaction_amount for r in clean.on_day(tx, "2021-02-15").collect()) == [1.0, 2.0]


def test_dedup_keeps_the_earlier_row_and_scopes_by_day(make):
    rows = [
        ("u", at(1 / 60), 2.0, "m", "DEBITO", "a"),
        ("u", at(0), 1.0, "m", "DEBITO", "a"),
        ("u", at(1440), 3.0, "m", "DEBITO", "a"),
        ("u", at(5), 4.0, "m", "DEBITO", None),
        ("u", at(4), 5.0, "m", "DEBITO", None),
    ]
    tx = make(rows)
    assert sorted(r.transaction_amount for r in clean.drop_duplicate_ids(tx).collect()) == [1.0, 5.0]
    by_day = clean.drop_duplicate_ids(tx, within_day=True)
    assert sorted(r.transaction_amount for r in by_day.collect()) == [1.0, 3.0, 5.0]


def test_dedup_limits_each_id_before_the_exchange(make):
    plan = clean.drop_duplicate_ids(make([("u", DAY, 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_large_dedup_is_dealt_by_rows(spark, make, monkeypatch):
    """More rows than the session's shuffle partitions should sort are more tasks; rows stay, NULL and hot ids too."""
    idents = [None] * 30 + ["hot"] * 60 + [f"i{n % 130}" for n in range(270)]
    tx = make([("u", at(1440 * (n % 2) + n), float(n), "m", "DEBITO", ident) for n, ident in enumerate(idents)])
    tx = tx.withColumn("_id", F.when(F.col("transaction_amount") >= 30, F.col("_id")))
    plain = [sorted(map(str, clean.drop_duplicate_ids(tx, day).collect())) for day in (False, True)]
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 5)
    for limit in (HeatLimit(), HeatLimit(500), HeatLimit(50), HeatLimit(20)):
        for day in (False, True):
            found = clean.drop_duplicate_ids(tx, day, sizes_from=tx.select("_id"), limit=limit)
            assert found.columns == tx.columns
            assert sorted(map(str, found.collect())) == plain[day]
    plan = clean.drop_duplicate_ids(tx, sizes_from=tx.select("_id"), limit=HeatLimit(500))._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\(_key#\d+L?, (\d+)\)", plan) == ["18"]
    # Cold ids are ranked where they were dealt; a hot id is cut in every map partition before its exchange.
    plan = clean.drop_duplicate_ids(tx, sizes_from=tx.select("_id"), limit=HeatLimit(50))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 3


def test_order_transactions_are_dealt_for_deduplication(spark, monkeypatch):
    """The queries' clean table follows the rows of the order lines, not the session's shuffle partitions."""
    plain = sorted(map(str, catalog.txo(spark, SMALL).collect()))
    assert catalog.txo(spark, SMALL).rdd.getNumPartitions() <= 4
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 100)
    found = catalog.txo(spark, SMALL)
    assert found.rdd.getNumPartitions() > 8
    assert sorted(map(str, found.collect())) == plain


def test_activity_filter_is_strict_and_optional(spark):
    df = spark.createDataFrame([(10,), (11,)], "cnt_24h int")
    assert [r[0] for r in clean.active_only(df).collect()] == [11]
    assert clean.active_only(df.withColumnRenamed("cnt_24h", "x")).count() == 2


def test_weekday_counts_from_monday(make):
    row = clean.calendar_parts(make([("u", at(61), 1.0)])).first()
    assert (row.weekday, row.hour, row.minute) == (0, 1, 1)


def test_id_rules(make):
    ids = ["0af", None, "0AF", "0 f", "0af"]
    tx = make([("u", DAY, 1.0, "m", "DEBITO", i) for i in ids])
    row = quality.id_format_check(tx).first()
    assert (row.not_hex, row.with_special) == (3, 1)
    row = quality.duplicate_count(tx).first()
    assert (row.rows, row.ids, row.repeated_ids, row.surplus_rows) == (5, 4, 1, 1)
    assert quality.duplicate_rows(tx).count() == 2
    twice_null = tx.unionByName(tx.where(F.col("_id").isNull()))
    assert quality.duplicate_rows(twice_null).where(F.col("_id").isNull()).count() == 2


def test_cardinality_lists_all_or_the_first_five(spark):
    df = spark.createDataFrame([(f"{i:02d}", "ab"[i % 2]) for i in range(21)], "many string, few string")
    got = {r["column"]: r for r in quality.text_cardinality(df).collect()}
    assert got["many"]["values"] == ["00", "01", "02", "03", "04"]
    assert got["many"].distinct_values == 21
    assert got["few"]["values"] == ["a", "b"]


def test_date_range_check_can_fail(make):
    tx = make([("u", at(0), 1.0), ("u", at(2880), 1.0)])
    assert quality.date_range_check(tx).first().outside == 0
    assert quality.date_range_check(tx, last="2021-02-16").first().outside == 1


def test_union_needs_equal_column_lists(make):
    tx = make([("u", DAY, 1.0)])
    assert transactions.union_strict(tx, tx).count() == 2
    with pytest.raises(ValueError):
        transactions.union_strict(tx, tx.select(*reversed(tx.columns)))


def test_ids_are_kept_once_over_batches(spark, make, tmp_path):
    def rows(*ids):
        return make([("u", at(i), float(i), "m", "DEBITO", x) for i, x in enumerate(ids)])

    first, second = rows("a", "b", "a", None, ""), rows("b", "c", None, "d", "c", "")
    path = str(tmp_path / "ids")
    with idindex.IdIndex(spark, path, buckets=3) as index:
        assert sorted(str(r._id) for r in index.add(first, "1").collect()) == ["", "None", "a", "b"]
    # Opened again by another job; a batch that is repeated gets its rows again.
    with idindex.IdIndex(spark, path, buckets=3) as index:
        for _ in range(2):
            assert sorted((r._id, r.transaction_amount) for r in index.add(second, "2").collect()) == [("c", 1.0), ("d", 3.0)]
        assert index.add(second, "3").count() == 0
        assert spark.table(index.name).count() == 6
        unseen = index.unseen(second, "4")
        plan = unseen._jdf.queryExecution().executedPlan().toString()
        side = plan[plan.index("SortMergeJoin") :].split("Bucketed: true")
        # Between the join and the bucketed scan there is no exchange on the index's side.
        assert len(side) == 2 and plan.count("Exchange hashpartitioning(_id") >= 1
        assert "Exchange" not in plan[plan.rindex("Exchange") + 8 :] and plan.rindex("Exchange") < plan.index("Bucketed: true")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ids_")]


def test_sketches_of_days_merge_to_any_range(spark, make):
    rows = [(f"u{i % 700}", at(1440 * (i % 5) + i % 60), 1.0, f"m{i % 13}", "DEBITO", f"id{i}") for i in range(4000)]
    sketches = quality.day_sketches(make(rows).unionByName(make(rows[:50])), ["_id", "user_id", "merchant_id"], "transaction_date")
    assert sketches.count() == 5
    for days, share in ((5, 4000), (2, 1600)):
        kept = sketches.where(F.col("day") < F.lit(DAY.date() + dt.timedelta(days=days)))
        found = {r.column: r.distinct_values for r in quality.merged_cardinality(kept).collect()}
        assert abs(found["_id"] - share) <= 0.05 * share and found["merchant_id"] == 13
    assert {r.distinct_values for r in quality.merged_cardinality(sketches.limit(0)).collect()} == {0}
