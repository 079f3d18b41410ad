import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from splitsight.schema import TRANSACTION  # noqa: E402
from splitsight.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
DAY = dt.datetime(2021, 2, 15)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(minutes: float, day: dt.datetime = DAY) -> dt.datetime:
    return day + dt.timedelta(minutes=minutes)


@pytest.fixture(scope="session")
def make(spark):
    """Transactions from (user, timestamp, amount, merchant, type) with defaults."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            user, ts, amount, *rest = row
            merchant = rest[0] if rest else "m1"
            kind = rest[1] if len(rest) > 1 else "DEBITO"
            ident = rest[2] if len(rest) > 2 else f"{i:032x}"
            full.append((ident, user, ts, amount, kind, merchant, "s1"))
        return spark.createDataFrame(full, TRANSACTION)

    return build
