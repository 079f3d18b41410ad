import pytest

import __spark_entry__ as entries
from check import differences, duck
from tests.conftest import SMALL

QUICK = [
    "user_day_features_holes",
    "coerced_transactions",
    "dedup_transactions",
    "id_format_examples",
    "amount_quantiles",
    "activity_bands",
    "structuring_profile",
    "rolling_24h",
    "rolling_24h_large_hot",
    "structuring_profile_hot",
    "stream_day_alerts_batches",
    "daily_sliding_features",
    "suspicion_scores",
    "forest_scores",
    "stream_24h_counts",
]


def test_every_sql_text_belongs_to_a_query():
    assert set(entries.oracle_sql()) <= set(entries.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    got = entries.queries()[name](spark, SMALL).toPandas()
    expected = duck(SMALL).execute(entries.oracle_sql()[name]).fetchdf()
    assert differences(got, expected) is None


def test_entry_returns_rows(spark):
    assert entries.entry(spark).limit(1).count() == 1
