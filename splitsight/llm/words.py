"""Helpers shared by the text operators: words of a text, Arrow batches, hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A word is a run of digits, a-z (after lower-casing A-Z) and characters outside ASCII.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _table() -> bytes:
    table = bytearray(b" " * 128) + bytearray(range(128, 256))
    for c in b"0123456789" + LOWER.encode():
        table[c] = c
    for upper, lower in zip(UPPER.encode(), LOWER.encode(), strict=True):
        table[upper] = lower
    return bytes(table)


WORD_BYTES = _table()


def words(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text; every byte that belongs to none counts as a gap."""
    return text.translate(WORD_BYTES).split() if text else []


def word_array(text: str | Column) -> Column:
    """The same words as an array column, without Python."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD_PATTERN), F.lit(0))


def utf8(column: pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes, None for null."""
    return column.cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes by word, kept for the first ``most`` distinct words of a task."""

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.most:
            self[word] = value
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, element by element."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all runs of ``size`` words; one of the whole text if it is shorter, none if empty."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mixed(total)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def tasks_over(batches: Iterable[pa.RecordBatch], size: int = 500) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``size`` rows, so that what is made from a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def tasks_by_bytes(batches: Iterable[pa.RecordBatch], text: int = 0, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices whose texts, in column ``text``, have at most ``most`` bytes together; a longer text stands alone."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            start = ends[at - 1] if at else 0
            end = max(int(np.searchsorted(ends, start + most, "right")), at + 1)
            yield batch.slice(at, end - at)
            at = end
