import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHES = ["digest", "row", "key", "copy", "spans", "items", "hit_spans", "score", "probability", "_words", "features", "place", "length"]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bcdfglmnrst") + rng.choice("aeiou") for _ in range(2 + w % 3)) if (w := rng.randrange(vocabulary)) >= 0 else "" for _ in range(n))


def rows_of(texts: list) -> list[tuple]:
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark):
    """A table of texts; further rows may be given whole."""

    def build(texts, more=()):
        return spark.createDataFrame([*rows_of(texts), *more], SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing names."""
    from pyspark.sql import functions as F

    long = prose(1, 30_000)
    texts = [None, "", " ", "one", prose(2, 80), prose(2, 80), prose(2, 79) + " new", long, long, "x" * 100_000, "é ñ 中文 " * 30]
    more = [(None, prose(2, 80), None, None, None), (None, None, None, None, None), (4, prose(2, 80), "en", "s", 7), (4, "other text of the same id " * 4, None, "s", 7), (4, "other text of the same id " * 4, None, "s", 7)]
    return documents(texts, more).withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
