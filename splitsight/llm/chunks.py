"""Substring deduplication by content-defined chunks.

A gear hash of the last 16 bytes decides at each blank whether a chunk ends there, so an
insertion moves no boundary beyond its neighbourhood. Where there are no blanks - after a character of a script
that is written without them, or ``LONG`` bytes after the last blank - it decides after each character. Chunks are short, so that whole ones fit into any
passage; since short ones recur by chance, ``IN_A_ROW`` chunks in a row are compared, by the digest of
their digests. Where these stand earlier too, the chunks are copies, and a stretch of copies is a repeat if it has
at least ``MIN_WORDS`` words, where ``WORD_CHARS`` characters without blanks count as one more. Whole chunks only are cut, so up to a few words at either end of a
repeated passage stay.

Texts are handled in parts of bounded size. A part hands on each distinct digest once, so that a
passage of any frequency is one entry per part; what comes back to a part are its digests that
occur in an earlier part.

Cases: a null or empty text has no chunks; of equal passages the first in the order of the stored parts
stays, within a row and between rows, so of repeated rows all but one are repeats; short texts are
never repeats; null ids are kept; an empty table gives no rows; other columns are not read. A chunk
is cut after ``MAX_BYTES`` at the latest, as in runs of one character. Digests have 64 bits: a chance collision touches one row of chunks,
which is no stretch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.llm.words import free_name, mixed, tasks_over, utf8
from splitsight.session import stored

# One blank in two ends a chunk, so that a passage of over 50 words holds whole chunks of 32 words or more.
SHARE = 1 / 2
MIN_BYTES, MAX_BYTES = 4, 512
MIN_WORDS = 32
# In stretches without blanks one character in twelve ends a chunk, and this many count as a word.
SHARE_UNSPACED = 1 / 12
WORD_CHARS = 4
LONG = 64
IN_A_ROW = 6
PART_CHUNKS = 500_000

GEAR = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash, 16 bits of it, after each byte: h = 2 h + GEAR[byte], modulo 2^16.

    Sixteen bytes on, a byte's part is shifted out; windows of 1, 2, 4 and 8 bytes are doubled.
    """
    h = (GEAR[data] & 0xFFFF).astype(np.uint16)
    for width in (1, 2, 4, 8):
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint16(width)
        h = longer
    return h


def blanks(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def unspaced(data: np.ndarray) -> np.ndarray:
    """Whether a character begins at a byte that is of a script without blanks (Chinese, Japanese, Thai, Lao,
    Tibetan, Burmese, Khmer) or stands ``LONG`` bytes or more after the last blank."""
    at = np.arange(len(data), dtype=np.int32)
    out = at - np.maximum.accumulate(np.where(blanks(data), at, np.int32(-1))) >= LONG
    high = np.flatnonzero(data >= 0xE0)
    if len(high):
        lead, second = data[high], data[np.minimum(high + 1, len(data) - 1)]
        scripts = (lead >= 0xE3) & (lead <= 0xE9) | (lead == 0xE0) & (second >= 0xB8)
        scripts |= (lead == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second == 0x9E) | (second == 0x9F))
        scripts |= (lead == 0xEF) & ((second >= 0xA4) & (second <= 0xAB) | (second >= 0xBC)) | (lead == 0xF0) & (second >= 0xA0)
        out[high[scripts]] = True
    return out & ((data & 0xC0) != 0x80)


def chunk_ends(text: bytes) -> list[int]:
    """Ends of the chunks of a text, in bytes."""
    data = np.frombuffer(text, np.uint8)
    hashed = gear(data) >> np.uint16(4)
    wanted = blanks(data) & (hashed < int(4096 * SHARE))
    dense = unspaced(data)
    if dense.any():
        # The last byte of each such character.
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        last = np.append(begins[1:], len(data))[dense[begins]] - 1
        wanted[last] |= hashed[last] < int(4096 * SHARE_UNSPACED)
    wanted = np.flatnonzero(wanted) + 1
    ends, last, size = [], 0, len(text)
    for at in [*wanted.tolist(), size]:
        while at - last > MAX_BYTES:
            last += MAX_BYTES
            while text[last] & 0xC0 == 0x80:
                last -= 1
            ends.append(last)
        if at - last >= MIN_BYTES or at == size and at > last:
            ends.append(at)
            last = at
    return ends


def row_digests(text: bytes, ends: list[int]) -> np.ndarray:
    """Digests of ``IN_A_ROW`` chunks from each chunk on that has so many."""
    starts = [0, *ends[:-1]]
    chunks = np.array([xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(starts, ends, strict=True)], np.uint64)
    n = len(chunks) - IN_A_ROW + 1
    if n <= 0:
        return chunks[:0]
    out = np.zeros(n, np.uint64)
    for k in range(IN_A_ROW):
        out = mixed(out + chunks[k : k + n])
    return out


def _parts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per part: its documents, and per chunk its length in characters, its words and its characters
    without blanks, in 11, 10 and 11 bits; per row of chunks the distance to its first copy in the part; the digests of first copies with their places."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, counts, digests, sizes, size = [], [], [], [], 0

        def part():
            hashes = np.concatenate(digests) if digests else np.zeros(0, np.uint64)
            unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            back = (np.arange(len(hashes)) - first[inverse]).astype("<u4")
            row = {
                "part": [task << 24 | number],
                "ids": [pa.concat_arrays(ids)],
                "counts": [np.array(counts, "<u4").tobytes()],
                "sizes": [np.concatenate(sizes).astype("<u4").tobytes() if sizes else b""],
                "back": [back.tobytes()],
                "digests": [unique.tobytes()],
                "places": [first.astype("<u4").tobytes()],
            }
            kind = pa.list_(ids[0].type)
            arrays = [pa.array(row["part"], pa.int64()), pa.array([x.to_pylist() for x in row["ids"]], kind)]
            return pa.RecordBatch.from_arrays(arrays + [pa.array(row[c], pa.binary()) for c in list(row)[2:]], list(row))

        for batch in tasks_over(batches, 200):
            ids.append(batch.column(doc_id))
            for t in utf8(batch.column(text)):
                ends = chunk_ends(t) if t else []
                counts.append(len(ends))
                if not ends:
                    continue
                digests.append(row_digests(t, ends))
                size += len(ends)
                data = np.frombuffer(t, np.uint8)
                blank = blanks(data)
                begins = ~blank
                begins[1:] &= blank[:-1]
                at = np.array([0, *ends[:-1]])
                chars, words, dense = (np.add.reduceat(x, at, dtype=np.int64) for x in ((data & 0xC0) != 0x80, begins, unspaced(data)))
                sizes.append(chars | words << 11 | dense << 21)
            if size >= PART_CHUNKS:
                yield part()
                number += 1
                ids, counts, digests, sizes, size = [], [], [], [], 0
        if ids:
            yield part()

    kind = docs.schema[doc_id].dataType.simpleString()
    binary = ", ".join(f"{c} binary" for c in ("counts", "sizes", "back", "digests", "places"))
    return docs.select(doc_id, text).mapInArrow(cut, f"part long, ids array<{kind}>, {binary}")


def _earlier(parts: DataFrame, n_buckets: int) -> DataFrame:
    """(part, places): the rows of chunks of a part, first copies there, that an earlier part has too."""

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(b << 64) // n_buckets for b in range(1, n_buckets)], np.uint64)
        for batch in tasks_over(batches, 1):
            digests = np.frombuffer(batch.column("digests")[0].as_py(), np.uint64)
            places = np.frombuffer(batch.column("places")[0].as_py(), "<u4")
            cut = [0, *np.searchsorted(digests, edges).tolist(), len(digests)]
            some = [b for b in range(n_buckets) if cut[b] < cut[b + 1]]
            columns = [pa.array(some, pa.int32()), pa.array([batch.column("part")[0].as_py()] * len(some), pa.int64())]
            columns += [pa.array([x[cut[b] : cut[b + 1]].tobytes() for b in some], pa.binary()) for x in (digests, places)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "part", "digests", "places"])

    def meet(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["part"].to_numpy(), kind="stable")
        names = rows["part"].to_numpy()[order]
        arrays = [[rows[c][int(i)].as_py() for i in order] for c in ("digests", "places")]
        digests = np.concatenate([np.frombuffer(x, np.uint64) for x in arrays[0]])
        places = np.concatenate([np.frombuffer(x, "<u4") for x in arrays[1]])
        owner = np.repeat(np.arange(len(names)), [len(x) // 4 for x in arrays[1]])
        by_digest = np.argsort(digests, kind="stable")
        later = np.zeros(len(digests), bool)
        ordered = digests[by_digest]
        later[by_digest[1:]] = ordered[1:] == ordered[:-1]
        out = [(int(names[k]), places[(owner == k) & later]) for k in np.unique(owner[later]).tolist()]
        return pa.table({"part": pa.array([p for p, _ in out], pa.int64()), "places": pa.array([x.tobytes() for _, x in out], pa.binary())})

    blocks = parts.select("part", "digests", "places").mapInArrow(spread, "bucket int, part long, digests binary, places binary")
    return blocks.groupBy("bucket").applyInArrow(meet, "part long, places binary")


def repeat_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: id, ``n_chunks``, ``n_repeated`` chunks in repeats, ``n_words`` and ``spans`` of repeats.

    Spans are in characters, end exclusive.
    """
    spark = docs.sparkSession
    parts = stored(_parts(docs, doc_id, text), "chunk-parts")
    earlier = _earlier(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = docs.schema[doc_id].dataType.simpleString()

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = {"id": [], "n_chunks": [], "n_repeated": [], "n_words": [], "spans": []}
        if left.num_rows:
            one = {c: left[c][0].as_py() for c in left.column_names if c != "ids"}
            counts = np.frombuffer(one["counts"], "<u4").astype(np.int64)
            sizes = np.frombuffer(one["sizes"], "<u4").astype(np.int64)
            chars, words, dense = sizes & 0x7FF, sizes >> 11 & 0x3FF, sizes >> 21
            back = np.frombuffer(one["back"], "<u4").astype(np.int64)
            known = np.zeros(len(back) + 1, bool)
            for x in right["places"].to_pylist():
                known[np.frombuffer(x, "<u4")] = True
            repeated = (back > 0) | known[np.arange(len(back)) - back]
            at = row = 0
            for n in counts.tolist():
                rows_here = max(0, n - IN_A_ROW + 1)
                first = np.flatnonzero(repeated[row : row + rows_here])
                change = np.zeros(n + 1, np.int32)
                np.add.at(change, first, 1)
                np.add.at(change, first + IN_A_ROW, -1)
                own = np.cumsum(change[:n]) > 0
                row += rows_here
                edges = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8))).reshape(-1, 2)
                place = np.concatenate(([0], np.cumsum(chars[at : at + n])))
                size = np.concatenate(([0], np.cumsum(words[at : at + n])))
                full = WORD_CHARS * size + np.concatenate(([0], np.cumsum(dense[at : at + n])))
                runs = [(a, b) for a, b in edges.tolist() if full[b] - full[a] >= WORD_CHARS * min_words]
                rows["n_chunks"].append(n)
                rows["n_repeated"].append(sum(b - a for a, b in runs))
                rows["n_words"].append(int(sum(size[b] - size[a] for a, b in runs)))
                rows["spans"].append([{"start": int(place[a]), "end": int(place[b])} for a, b in runs])
                at += n
        ids = left["ids"].combine_chunks().flatten() if left.num_rows else left["ids"].combine_chunks().values[:0]
        pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        numbers = [pa.array(rows[c], pa.int64()) for c in ("n_chunks", "n_repeated", "n_words")]
        return pa.Table.from_arrays([ids, *numbers, pa.array(rows["spans"], pairs)], ["id", "n_chunks", "n_repeated", "n_words", "spans"])

    contents = parts.drop("digests", "places").groupBy("part")
    schema = f"id {kind}, n_chunks long, n_repeated long, n_words long, spans array<struct<start:long,end:long>>"
    return contents.cogroup(earlier.groupBy("part")).applyInArrow(finish, schema).withColumnRenamed("id", doc_id)


def without_repeats(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows with repeats cut out of their texts; the other columns as they are."""
    row, known, cut_at = (free_name(docs, name) for name in ("row", "row_of_spans", "spans"))
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "chunk-rows")
    found = repeat_spans(rows, row, text, min_words).where("n_repeated > 0").select(F.col(row).alias(known), F.col("spans").alias(cut_at))
    # The pieces between the spans, in order.
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col(f"{cut_at}.end"))
    stops = F.concat(F.col(f"{cut_at}.start"), F.array(F.length(text).cast("long")))
    pieces = F.transform(F.arrays_zip(begins.alias("a"), stops.alias("b")), lambda p: F.substring(F.col(text), (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    cut = F.when(F.col(cut_at).isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))
    joined = rows.join(found, F.col(row) == F.col(known), "left")
    return joined.select(*[cut.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
