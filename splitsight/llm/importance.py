"""Target-distribution importance resampling: rows drawn as if from another corpus.

Raw and target texts are compared by hashed word n-grams. A bucket's gain is the scaled logarithm of how much
commoner it is in the target; a text weighs the sum of the gains of its n-grams, and Gumbel noise from a hash of
its id turns the highest scores into a draw without replacement in proportion to those weights.

Words of a batch are found in one regex pass over its texts, joined with separators that no word holds. The place of a
word among the offsets of the texts says whose it is; n-grams that cross from one text into the next are
masked, and the buckets of the others are added up with bincount. A pass is read in runs of words, so that a
very long text is never held as a list of words; the last words of a run are kept for the n-grams into the next.

Counts, weights and ranks cover all rows. Ranks come from one sort over all tasks and the sizes of its partitions.

Cases: a null text has no words; a null id is hashed as an empty one and goes first among ties; rows are
scored one by one, so repeated rows and ids get their own lines, and further ties go by stored order; without target
texts every bucket's gain follows from the smoothing alone; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitsight.llm.places import numbered
from splitsight.llm.words import tasks_by_bytes, utf8
from splitsight.session import stored

# After lower-casing A-Z, bytes of a word: digits, a-z and everything outside ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"
WORDS_AT_ONCE = 100_000


@dataclass(frozen=True)
class Features:
    """Runs of ``shortest`` to ``longest`` words, hashed into ``buckets``."""

    shortest: int = 1
    longest: int = 2
    buckets: int = 10_000


class Buckets(dict):
    """Buckets by feature, kept for the first ``most`` distinct ones of a task."""

    def __init__(self, buckets: int, most: int = 400_000):
        self.buckets, self.most = buckets, most

    def __missing__(self, feature: bytes) -> int:
        value = zlib.crc32(feature) % self.buckets
        if len(self) < self.most:
            self[feature] = value
        return value


def word_runs(texts: list[bytes | None], most: int = WORDS_AT_ONCE) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(words, number of the text of each) of a batch of texts, in runs of at most ``most`` words."""
    blob = SEPARATOR.join(t or b"" for t in texts).lower()
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    found = WORD.finditer(blob)
    while run := list(islice(found, most)):
        starts = np.fromiter((m.start() for m in run), np.int64, len(run))
        yield [m.group() for m in run], np.searchsorted(ends, starts, "right")


def feature_runs(texts: list[bytes | None], kind: Features, buckets: Buckets, most: int = WORDS_AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Run by run: the number of the text of each word, and the bucket and number of the text of each feature."""
    kept, kept_of = [], np.zeros(0, np.int64)
    for new, new_of in word_runs(texts, most):
        words, of = kept + new, np.concatenate([kept_of, new_of])
        found, found_of = [], []
        for n in range(kind.shortest, kind.longest + 1):
            # From the first n-gram that ends among the new words; masked are those that begin in another text.
            at = np.arange(max(len(kept) - n + 1, 0), max(len(words) - n + 1, 0))
            at = at[of[at] == of[at + n - 1]]
            named = (b" ".join(words[i : i + n]) for i in at) if n > 1 else (words[i] for i in at)
            found.append(np.fromiter(map(buckets.__getitem__, named), np.int64, len(at)))
            found_of.append(of[at])
        yield new_of, np.concatenate(found), np.concatenate(found_of)
        keep = min(kind.longest - 1, len(words))
        kept, kept_of = words[len(words) - keep :], of[len(of) - keep :]


def bucket_counts(docs: DataFrame, kind: Features = Features(), text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Buckets(kind.buckets), np.zeros(kind.buckets, np.int64)
        for batch in tasks_by_bytes(batches):
            for _, found, _ in feature_runs(utf8(batch.column(0)), kind, own):
                total += np.bincount(found, minlength=kind.buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    return docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, kind: Features = Features(), scale: int = 1000, text: str = "text") -> np.ndarray:
    """The gain of every bucket: floor(scale * ln(smoothed target share / smoothed raw share)).

    ``kind.buckets`` numbers a table reach the driver.
    """

    def counted(docs: DataFrame) -> np.ndarray:
        out = np.zeros(kind.buckets, np.int64)
        for r in bucket_counts(docs, kind, text).collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = counted(raw).tolist(), counted(target).tolist()
    all_s, all_t = float(sum(s) + kind.buckets), float(sum(t) + kind.buckets)
    gains = [math.floor(scale * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s, t, strict=True)]
    return np.array(gains, np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, kind: Features = Features(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``n_features`` and ``weight``, the sum of the gains of its features."""

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Buckets(kind.buckets)
        for batch in tasks_by_bytes(batches, 1):
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for words_of, found, of in feature_runs(utf8(batch.column(1)), kind, own):
                words += np.bincount(words_of, minlength=len(words))
                features += np.bincount(of, minlength=len(words))
                np.add.at(weight, of, gains[found])
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weight))], ["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind_of_id = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"id {kind_of_id}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int, scale: int = 1000) -> Column:
    """floor(-scale * ln(-ln(u))), u from the first 32 bits of the SHA-256 of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-scale * F.log(-F.log(u)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    kind: Features = Features(),
    scale: int = 1000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: id, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the rows with at least ``min_words`` words, ``percent`` of a hundred are drawn, rounded down: those of the
    highest scores, ties to the smaller id. ``rank`` is their place from 1, null for the others.
    """
    gains = bucket_gains(docs, target, kind, scale, text)
    rows = weighed(docs, gains, kind, doc_id, text).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed, scale))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    eligible = F.col("n_words") >= min_words
    ordered = numbered(rows.where(eligible), [F.desc("score"), F.col("id").asc_nulls_first(), F.col("row")])
    drawn = percent * rows.where(eligible).count() // 100
    ranked = ordered.withColumn("rank", F.when(F.col("at") < drawn, F.col("at") + 1)).drop("at")
    found = ranked.unionByName(rows.where(~eligible).withColumn("rank", F.lit(None).cast("long")))
    return found.select(F.col("id").alias(doc_id), "n_features", "weight", "score", "rank")
