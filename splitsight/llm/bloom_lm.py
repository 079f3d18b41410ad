"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

A count c is stored as the levels 1 .. 1 + floor(log2 c) of its n-gram, so that a count is read by probing
level after level until one is missing. The model is a bigram with a Dirichlet prior, and every count in it is read
from the filter, whatever the size of the corpus:

    p(w | v) = (c(v, w) + PRIOR * (c(w) + 1) / (N + V + 1)) / (c(v) + PRIOR)

1. Words are counted exactly. The commonest, at most ``HOT``, are listed.
2. The texts are read once more, in parts of bounded size. A part hands on, for each bucket of the filter, its distinct pairs
   in that bucket, their training counts and the documents they stand in. A pair lies in the bucket of its second word; the
   pairs of a common word are spread over as many places as its count asks, so that no bucket holds all of them.
3. One shuffle brings the parts of a bucket together. The bucket's segment of the filter is built there and stored
   beside the parts. The number of buckets follows from the number of tokens.
4. The segments are broadcast in shards of at most ``SHARD_BYTES``. The pass of a shard reads the parts of its own
   buckets only and sums up logarithms by document, so all passes together read each pair once. What listed words get from
   the filter is probed once and broadcast, as they are needed in every shard.

The base score uses exact counts: those of the list at once, those of other words by a join.

Cases: a null text is empty and has the end token alone; a null id counts as the empty text for the
split into training and held-out rows; rows are scored one by one, so repeated rows all get their score;
without training rows every base probability is 1; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from splitsight.llm.words import LOWER, UPPER, mixed, tasks_by_bytes, utf8
from splitsight.session import scratch_path, stored

HOT = 1_000_000
PRIOR = 100.0
BITS_PER_ENTRY, PROBES = 10, 5
SHARD_BYTES = 48 << 20
# Tokens, or documents, after which a task hands on what it has counted; documents are numbered in 16 bits.
CHUNK, MOST_DOCUMENTS = 1_000_000, 50_000
# Bytes of text that are split into words at a time, and rows of packed pairs that are handed on at a time.
TEXT_BYTES, BLOCKS = 2 << 20, 16
# Tokens of the corpus for each bucket of the filter.
BUCKET_TOKENS = 2_000_000

LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
# Neither can be a word: words are not empty and hold no white space.
END, START = b"", b" "

PLACE = np.uint64(40)
LOW_BITS, NARROW_BITS = np.uint64((1 << 40) - 1), np.uint64((1 << 32) - 1)
# Words of a higher count tell the words before them apart by 40 bits, others by 32.
NARROW = 1 << 22
STEP = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes | None) -> list[bytes]:
    found = text.translate(LOWERED).split() if text else []
    found.append(END)
    return found


def held_out(doc_id: str, share: int = 7, part: int = 2) -> Column:
    """Whether the CRC-32 of the id, as text, leaves ``part`` when divided by ``share``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % share == part


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


# --- words and n-grams of a batch ---------------------------------------------------------------


class Vocabulary(dict):
    """Slots by word; for each slot the word's hash and its place in the list, from 1 (0 if it isn't listed).

    ``most`` words stay from batch to batch, others for one batch.
    """

    def __init__(self, listed: np.ndarray, most: int = 400_000):
        self.listed = listed
        self.most = most
        self.hashes = np.zeros(0, np.uint64)
        self.codes = np.zeros(0, np.uint32)
        self.new: list[int] = []

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self.hashes) + len(self.new)
        self.new.append(word_hash(word))
        return slot

    def of(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.most:
            self.clear()
            self.hashes, self.codes = self.hashes[:0], self.codes[:0]
        slots = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        if self.new:
            hashes = np.array(self.new, np.uint64)
            codes = np.zeros(len(hashes), np.uint32)
            if len(self.listed):
                at = np.minimum(np.searchsorted(self.listed, hashes), len(self.listed) - 1)
                codes = np.where(self.listed[at] == hashes, at + 1, 0).astype(np.uint32)
            self.hashes = np.concatenate((self.hashes, hashes))
            self.codes = np.concatenate((self.codes, codes))
            self.new = []
        return self.hashes[slots], self.codes[slots]


def single_ids(hashes: np.ndarray) -> np.ndarray:
    """Ids of words: the top 24 bits are those of the word's hash and give the place."""
    return (hashes & ~LOW_BITS) | (mixed(hashes + STEP) & LOW_BITS)


def pair_lows(before: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What tells the pairs of a second word apart."""
    lows = mixed(before * STEP + hashes) & LOW_BITS
    return np.where(counts > NARROW, lows, lows & NARROW_BITS)


def pair_ids(hashes: np.ndarray, counts: np.ndarray, lows: np.ndarray, grain: int) -> np.ndarray:
    """Ids of pairs: placed with the second word, or, for each ``grain`` of its count, at a place more."""
    salts = lows % (counts // grain + 1).astype(np.uint64)
    places = np.where(salts > 0, mixed(hashes + salts * STEP), hashes)
    return (places & ~LOW_BITS) | lows


def histories(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[starts] = word_hash(START)
    return before


def batch_tokens(batch: pa.RecordBatch, text: str) -> tuple[list[bytes], np.ndarray]:
    """All tokens of a batch and where each document begins."""
    found: list[bytes] = []
    starts = []
    for t in utf8(batch.column(text)):
        starts.append(len(found))
        found += tokens(t)
    return found, np.array(starts, np.int64)


# --- counting -----------------------------------------------------------------------------------


def word_counts(train: DataFrame, text: str) -> DataFrame:
    """Exact counts by word hash (64 bits stand for the word)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def rows():
            hashes = np.fromiter(map(word_hash, seen), np.uint64, len(seen)).view(np.int64)
            numbers = np.fromiter(seen.values(), np.int64, len(seen))
            return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(numbers)], ["word", "c"])

        for batch in tasks_by_bytes(batches, 0, TEXT_BYTES):
            seen.update(batch_tokens(batch, text)[0])
            if len(seen) > CHUNK // 2:
                yield rows()
                seen.clear()
        yield rows()

    return train.select(text).mapInArrow(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def listed_words(counts: DataFrame, most: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of the most frequent words, at most ``most``."""
    level = F.floor(F.log2("c") * 8)
    by_level = sorted(((r.level, r.n) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = math.inf, 0
    for at, n in by_level:
        total += n
        if total > most:
            break
        least = at
    if least == math.inf:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = counts.where(level >= F.lit(least)).toArrow()
    hashes = rows["word"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], rows["c"].to_numpy()[order]


def quantised(counts: np.ndarray) -> np.ndarray:
    """The number of levels of each count."""
    return np.floor(np.log2(counts)).astype(np.int64) + 1


def represented(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that have so many levels; 0 for none."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1) - 0.5, 0.0)


def bit_places(ids: np.ndarray, level: int, bits: np.ndarray, probe: int) -> np.ndarray:
    h = mixed(ids + np.uint64(level * int(STEP) & 0xFFFFFFFFFFFFFFFF))
    part = ((h & np.uint64(0xFFFFFFFF)) + np.uint64(probe) * (h >> np.uint64(32) | np.uint64(1))) & np.uint64(0xFFFFFFFF)
    return (part * bits.astype(np.uint64)) >> np.uint64(32)


def buckets_of(ids: np.ndarray, n: int) -> np.ndarray:
    return ((ids >> PLACE) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def bucket_edges(n: int) -> np.ndarray:
    """The least id of each bucket, and the end of the last."""
    firsts = [-(-(b << 24) // n) << 40 for b in range(n)]
    return np.array([*firsts, (1 << 64) - 1], np.uint64)


def cut_at(ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that ascending ids lie in and where those of each bucket begin and end."""
    cut = np.searchsorted(ids, edges)
    cut[-1] = len(ids)
    some = np.flatnonzero(np.diff(cut))
    return some, np.column_stack((cut[some], cut[some + 1]))


# Pairs of a part in one bucket: ``codes`` of the distinct second words and hashes of those that aren't listed in ``rare``; of the distinct
# pairs the word's number and what tells it apart in ``ids``, training counts in ``numbers`` and ``runs`` of places; documents of all in ``places``.
PACKED = ("ids", "numbers", "codes", "rare", "runs", "places")
# What is known of the documents of a part.
PER_DOCUMENT = {"held_out": "boolean", "n_tokens": "long", "n_listed": "long", "listed_logs": "double", "others": "array<long>"}


def parts_schema(kind: str) -> str:
    packed = ", ".join(f"{c} binary" for c in PACKED)
    rows = ", ".join(f"{c} array<{t}>" for c, t in {"doc_id": kind, **PER_DOCUMENT}.items())
    return f"bucket int, part long, bits long, segment binary, {packed}, {rows}"


def _table(names: list[str], columns: dict[str, pa.Array], n: int, types: pa.Schema) -> pa.RecordBatch:
    """A batch of all columns, null where none is given."""
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, types.field(c).type) for c in names], schema=types)


def _types(kind: pa.DataType) -> pa.Schema:
    lists = {"doc_id": kind, "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_listed": pa.int64(), "listed_logs": pa.float64(), "others": pa.list_(pa.int64())}
    head = {"bucket": pa.int32(), "part": pa.int64(), "bits": pa.int64(), "segment": pa.binary()}
    return pa.schema([*head.items(), *((c, pa.binary()) for c in PACKED), *((c, pa.list_(t)) for c, t in lists.items())])


@functools.cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


def packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first, compressed; of hashes the differences, which are small if they ascend."""
    if values.dtype == np.uint64:
        values = np.diff(values, prepend=np.uint64(0))
    return _compressor().compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()) if len(values) else b""


def unpacked(data: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    values = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=np.uint64) if kind == np.uint64 else values


def _binary(pieces: list[np.ndarray]) -> pa.Array:
    return pa.array([packed(p) for p in pieces], pa.binary())


def packed_pairs(hashes: np.ndarray, codes: np.ndarray, lows: np.ndarray, buckets: np.ndarray, owners: np.ndarray, train: np.ndarray) -> dict[str, pa.Array]:
    """The pairs of a part as one row per bucket; ``train`` says which are learnt from."""
    words, number = np.unique(hashes, return_inverse=True)
    keys = number.astype(np.uint64) << PLACE | lows
    order = np.argsort(keys)
    # By bucket, and in it by word; numbers of 16 bits are sorted in linear time.
    small = buckets.astype(np.uint16) if buckets.max() < 1 << 16 else buckets
    order = order[np.argsort(small[order], kind="stable")]
    keys, buckets = keys[order], buckets[order]
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (buckets[1:] != buckets[:-1]))))
    ends = np.append(first, len(keys))
    number, lows, buckets = number[order[first]], keys[first] & LOW_BITS, buckets[first]
    code = codes[order[first]]
    numbers = np.add.reduceat(train[order], first, dtype=np.int64).astype("<i8")
    runs, places = np.diff(ends).astype("<u4"), owners[order].astype("<u2")
    found, at = np.unique(buckets, return_index=True)
    columns = {c: [] for c in PACKED}
    for low, high in zip(at, np.append(at[1:], len(buckets)), strict=True):
        new = np.concatenate(([True], number[low + 1 : high] != number[low : high - 1]))
        own, listed = np.flatnonzero(new) + low, code[low:high][new]
        columns["codes"].append(listed)
        columns["rare"].append(words[number[own[listed == 0]]])
        columns["ids"].append((np.cumsum(new) - 1).astype(np.uint64) << PLACE | lows[low:high])
        columns["numbers"].append(numbers[low:high])
        columns["runs"].append(runs[low:high])
        columns["places"].append(places[ends[low] : ends[high]])
    return {"bucket": pa.array(found, pa.int32())} | {c: _binary(x) for c, x in columns.items()}


def unpacked_pairs(row: dict, listed: np.ndarray, counts: np.ndarray, grain: int) -> tuple[np.ndarray, ...]:
    """The ids of a row's pairs, the number of each one's second word, and codes and hashes of these words."""
    keys, codes = unpacked(row["ids"], "<u8"), unpacked(row["codes"], "<u4").astype(np.int64)
    hashes, word_counts = np.empty(len(codes), np.uint64), np.zeros(len(codes), np.int64)
    there = codes > 0
    hashes[there], word_counts[there] = listed[codes[there] - 1], counts[codes[there] - 1]
    hashes[~there] = unpacked(row["rare"], "<u8")
    number = (keys >> PLACE).astype(np.int64)
    return pair_ids(hashes[number], word_counts[number], keys & LOW_BITS, grain), number, codes, hashes


def pair_parts(docs: DataFrame, doc_id: str, text: str, shared_list, n_buckets: int, grain: int) -> DataFrame:
    """Rows of pairs by part and bucket, and one row per part, in a bucket below 0, of what is known of its documents."""
    kind = docs.schema[doc_id].dataType.simpleString()
    n_tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts = shared_list.value
        vocabulary, by_code = Vocabulary(listed), np.concatenate(([0], counts))
        logs = np.log10(by_code + 1.0)
        task, number = TaskContext.get().partitionId(), 0
        types = waiting = None

        def part() -> Iterator[pa.RecordBatch]:
            own = (task << 32) + number
            known = [w.pop() for w in waiting]
            columns = [np.concatenate(x) for x in zip(*waiting, strict=True)]
            waiting.clear()
            rows = packed_pairs(*columns)
            del columns
            n = len(rows["bucket"])
            rows = _table(types.names, rows | {"part": pa.array([own] * n, pa.int64())}, n, types)
            for at in range(0, n, BLOCKS):
                yield rows.slice(at, BLOCKS)
            columns = {c: pa.concat_arrays([x[c] for x in known]) for c in ("doc_id", *PER_DOCUMENT)}
            columns = {c: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for c, x in columns.items()}
            columns |= {"bucket": pa.array([-1 - (task * 7919 + number) % n_tasks], pa.int32()), "part": pa.array([own], pa.int64())}
            yield _table(types.names, columns, 1, types)

        size = n_docs = 0
        for batch in tasks_by_bytes(batches, 1, TEXT_BYTES):
            if not batch.num_rows:
                continue
            if types is None:
                types, waiting = _types(batch.column(0).type), []
            if n_docs + batch.num_rows > MOST_DOCUMENTS and waiting:
                yield from part()
                size, n_docs, number = 0, 0, number + 1
            found, starts = batch_tokens(batch, text)
            hashes, codes = vocabulary.of(found)
            lengths = np.diff(np.append(starts, len(found)))
            listed_here = codes > 0
            others = np.concatenate(([0], np.cumsum(~listed_here)))
            known = {
                "doc_id": batch.column(doc_id),
                "held_out": batch.column("held_out"),
                "n_tokens": pa.array(lengths, pa.int64()),
                "n_listed": pa.array(np.add.reduceat(listed_here.astype(np.int64), starts)),
                "listed_logs": pa.array(np.add.reduceat(logs[codes], starts)),
                "others": pa.ListArray.from_arrays(pa.array(np.append(others[starts], others[-1]), pa.int32()), pa.array(hashes[~listed_here].view(np.int64))),
            }
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            owners = np.repeat(np.arange(n_docs, n_docs + len(starts), dtype=np.uint16), lengths)
            lows = pair_lows(histories(hashes, starts), hashes, by_code[codes])
            buckets = buckets_of(pair_ids(hashes, by_code[codes], lows, grain), n_buckets).astype(np.int32)
            waiting.append([hashes, codes, lows, buckets, owners, ~np.repeat(held, lengths), known])
            size, n_docs = size + len(found), n_docs + batch.num_rows
            if size >= CHUNK:
                yield from part()
                size, n_docs, number = 0, 0, number + 1
        if waiting:
            yield from part()

    return docs.select(doc_id, text, "held_out").mapInArrow(parts, parts_schema(kind))


def word_parts(counts: DataFrame, n_buckets: int, schema: str, types: pa.Schema) -> DataFrame:
    """The counts of words, packed by bucket as those of pairs are."""

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = bucket_edges(n_buckets)
        for batch in batches:
            ids = single_ids(batch.column("word").to_numpy().view(np.uint64))
            order = np.argsort(ids)
            ids, numbers = ids[order], batch.column("c").to_numpy()[order].astype("<i8")
            buckets, cuts = cut_at(ids, edges)
            columns = {"bucket": pa.array(buckets, pa.int32())}
            columns |= {"ids": _binary([ids[a:b] for a, b in cuts]), "numbers": _binary([numbers[a:b] for a, b in cuts])}
            yield _table(types.names, columns, len(buckets), types)

    return counts.mapInArrow(parts, schema)


def segment_of(ids: np.ndarray, numbers: np.ndarray, bits_per_entry: int, probes: int) -> tuple[int, bytes]:
    """The number of bits and the bits of a bucket's filter."""
    order = np.argsort(ids)
    ids, numbers = ids[order], numbers[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    ids, levels = ids[first], quantised(np.add.reduceat(numbers, first))
    bits = -(-int(levels.sum()) * bits_per_entry // 64) * 64
    segment = np.zeros(bits // 8, np.uint8)
    for level in range(1, int(levels.max()) + 1):
        own = ids[levels >= level]
        for probe in range(probes):
            at = bit_places(own, level, np.full(len(own), bits), probe)
            np.bitwise_or.at(segment, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return bits, segment.tobytes()


def with_segments(rows: DataFrame, shared_list, grain: int, schema: str, bits_per_entry: int, probes: int) -> DataFrame:
    """The rows of pairs and documents, and one row per bucket with its segment of the filter."""

    def build(found: pa.Table) -> pa.Table:
        if found["bucket"][0].as_py() < 0:
            return found
        listed, counts = shared_list.value
        ids = []
        for k in range(found.num_rows):
            row = found.slice(k, 1).select(["part", "ids", "codes", "rare"]).to_pylist()[0]
            ids.append(unpacked(row["ids"], "<u8") if row["part"] is None else unpacked_pairs(row, listed, counts, grain)[0])
        ids = np.concatenate(ids)
        numbers = np.concatenate([unpacked(x, "<i8") for x in found["numbers"].to_pylist()])
        learned = numbers > 0
        passed = found.filter(pc.is_valid(found["part"]))
        numbers_at = passed.schema.get_field_index("numbers")
        passed = passed.set_column(numbers_at, passed.schema.field(numbers_at), pa.nulls(len(passed), pa.binary()))
        if not learned.any():
            return passed
        bits, segment = segment_of(ids[learned], numbers[learned], bits_per_entry, probes)
        columns = {"bucket": pa.array([found["bucket"][0].as_py()], pa.int32()), "bits": pa.array([bits], pa.int64()), "segment": pa.array([segment], pa.binary())}
        return pa.concat_tables([passed, pa.Table.from_batches([_table(found.schema.names, columns, 1, found.schema)])])

    return rows.groupBy("bucket").applyInArrow(build, schema)


class Shard:
    """The segments of some buckets."""

    def __init__(self, rows: list, n_buckets: int, probes: int = PROBES):
        self.n_buckets, self.probes = n_buckets, probes
        self.bits = np.zeros(n_buckets, np.int64)
        self.start = np.zeros(n_buckets, np.int64)
        at = 0
        for r in rows:
            self.bits[r.bucket], self.start[r.bucket] = r.bits, at
            at += len(r.segment)
        self.bytes = np.frombuffer(b"".join(r.segment for r in rows), np.uint8)

    def levels(self, ids: np.ndarray) -> np.ndarray:
        """The levels of n-grams that the filter holds; 0 for those that are elsewhere."""
        levels = np.zeros(len(ids), np.int64)
        bucket = buckets_of(ids, self.n_buckets)
        bits, start = self.bits[bucket], self.start[bucket]
        left = np.flatnonzero(bits)
        level = 1
        while len(left):
            own, own_bits, own_start = ids[left], bits[left], start[left]
            for probe in range(self.probes):
                at = bit_places(own, level, own_bits, probe).astype(np.int64)
                there = (self.bytes[own_start + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 > 0
                left, own, own_bits, own_start = left[there], own[there], own_bits[there], own_start[there]
            levels[left] = level
            level += 1
        return levels

    def counts(self, ids: np.ndarray) -> np.ndarray:
        return represented(self.levels(ids))


# --- scoring ------------------------------------------------------------------------------------


def shard_sums(parts: DataFrame, shared_shard, shared_list, shared_known, grain: int, totals: tuple[int, int, int]) -> DataFrame:
    """(part, bucket, owners, sums): what the pairs of each part in each bucket add to its documents' scores."""
    n_tokens, n_words, _ = totals

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, (listed, counts), known_counts = shared_shard.value, shared_list.value, shared_known.value
        end = np.uint64(word_hash(END))
        for batch in batches:
            owners, sums = [], []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids, number, codes, words = unpacked_pairs(row, listed, counts, grain)
                known = np.empty(len(codes))
                known[codes > 0] = known_counts[codes[codes > 0] - 1]
                known[codes == 0] = shard.counts(single_ids(words[codes == 0]))
                history = np.where(words == end, 0.0, np.log10(known + PRIOR))
                lower = PRIOR * (known + 1) / (n_tokens + n_words + 1)
                logs = np.log10(shard.counts(ids) + lower[number]) - history[number]
                runs, places = unpacked(row["runs"], "<u4"), unpacked(row["places"], "<u2")
                total = np.bincount(places, np.repeat(logs, runs))
                own = np.unique(places)
                owners.append(own.astype("<u2"))
                sums.append(total[own].astype("<f8"))
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("bucket"), _binary(owners), _binary(sums)], ["part", "bucket", "owners", "sums"])

    return parts.select("part", "bucket", "ids", "codes", "rare", "runs", "places").mapInArrow(score, SUMS)


SUMS = "part long, bucket int, owners binary, sums binary"


def listed_counts(segments: DataFrame, shared_list, n_buckets: int, probes: int) -> np.ndarray:
    """The counts that the filter gives for the listed words."""

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, _ = shared_list.value
        ids = single_ids(words)
        bucket = buckets_of(ids, n_buckets)
        for batch in batches:
            for b, bits, segment in zip(*(batch.column(c).to_pylist() for c in ("bucket", "bits", "segment")), strict=True):
                own = np.flatnonzero(bucket == b)
                row = type("Segment", (), {"bucket": b, "bits": bits, "segment": segment})
                levels = Shard([row], n_buckets, probes).levels(ids[own])
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(levels, pa.int32())], ["place", "level"])

    found = segments.select("bucket", "bits", "segment").mapInArrow(probe, "place int, level int").toArrow()
    levels = np.zeros(len(shared_list.value[0]), np.int64)
    levels[found["place"].to_numpy()] = found["level"].to_numpy()
    return represented(levels)


def _documents(parts: DataFrame, sums: DataFrame, kind: str, n_docs: int) -> DataFrame:
    """Rows of the documents with their scores, the buckets of each part added in their order."""

    def add(known: pa.Table, found: pa.Table) -> pa.Table:
        columns = {c: pa.concat_arrays([x.values for x in known[c]]) for c in ("doc_id", *PER_DOCUMENT)}
        score = np.full(len(columns["doc_id"]), -math.log10(n_docs + PRIOR))
        for _, owners, part in sorted(zip(*(found[c].to_pylist() for c in ("bucket", "owners", "sums")), strict=True)):
            score[unpacked(owners, "<u2")] += unpacked(part, "<f8")
        return pa.table(columns | {"score": pa.array(score)})

    schema = ", ".join(f"{c} {t}" for c, t in {"doc_id": kind, **PER_DOCUMENT, "score": "double"}.items())
    known = parts.where("bucket < 0").select("part", "doc_id", *PER_DOCUMENT)
    return known.groupBy("part").cogroup(sums.groupBy("part")).applyInArrow(add, schema)


def corpus_scores(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    hot: int = HOT,
    shard_bytes: int = SHARD_BYTES,
    bits_per_entry: int = BITS_PER_ENTRY,
    probes: int = PROBES,
    bucket_tokens: int = BUCKET_TOKENS,
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``hot`` and ``shard_bytes`` divide the work and change no formula; another ``hot`` or ``bucket_tokens`` moves n-grams to other segments, so
    that other ones are found by mistake (about one in a hundred of those never seen, fewer with more ``bits_per_entry``).
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(doc_id, text, held_out(doc_id).alias("held_out"))
    counts = stored(word_counts(docs.where(~F.col("held_out")), text), "word-counts")
    totals = counts.agg(F.sum("c"), F.count("*"), F.max(F.when(F.col("word") == _signed(word_hash(END)), F.col("c")))).first()
    n_tokens, n_words, n_docs = (x or 0 for x in totals)
    listed = spark.sparkContext.broadcast(listed_words(counts, hot))
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_tokens // bucket_tokens))
    # Pairs of one word and place are an eighth of a bucket at most, but for words that are too rare to be listed.
    grain = max(bucket_tokens // 8, 1)
    schema = parts_schema(kind)
    types = _types(to_arrow_type(docs.schema[doc_id].dataType))
    rows = pair_parts(docs, doc_id, text, listed, n_buckets, grain).unionByName(word_parts(counts, n_buckets, schema, types))
    path = scratch_path(spark, "pairs-by-bucket")
    with_segments(rows, listed, grain, schema, bits_per_entry, probes).write.partitionBy("bucket").parquet(path)
    parts = spark.read.schema(schema).parquet(path)
    segments = parts.where("bucket >= 0 AND part IS NULL")
    known = spark.sparkContext.broadcast(listed_counts(segments, listed, n_buckets, probes))
    sums = scratch_path(spark, "pair-sums")
    for low, high in _shards(segments.select("bucket", "bits").collect(), n_buckets, shard_bytes):
        inside = (F.col("bucket") >= low) & (F.col("bucket") < high)
        shard = spark.sparkContext.broadcast(Shard(segments.where(inside).select("bucket", "bits", "segment").collect(), n_buckets, probes))
        shard_sums(parts.where(inside & F.col("part").isNotNull()), shard, listed, known, grain, (n_tokens, n_words, n_docs)).write.parquet(f"{sums}/shard={low}")
        shard.destroy()
    scored = _documents(parts, spark.read.schema(SUMS).parquet(sums), kind, n_docs)
    rows = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    known_words = (
        rows.select("row", F.explode("others").alias("word"))
        .join(counts.hint("merge"), "word")
        .groupBy("row")
        .agg(F.sum(F.log10(F.col("c") + 1.0)).alias("rare_logs"), F.count("*").alias("n_rare"))
    )
    return rows.drop("others").join(known_words.hint("merge"), "row", "left").select(
        F.col("doc_id").alias(doc_id),
        "held_out",
        "n_tokens",
        (F.col("n_listed") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("listed_logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * math.log10(n_tokens + n_words + 1)).alias("base_score"),
        "score",
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _shards(sizes: list, n_buckets: int, shard_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of buckets of at most ``shard_bytes`` of segments (or one bucket), together all buckets."""
    by_bucket = {r.bucket: r.bits // 8 for r in sizes}
    low = total = 0
    for b in range(n_buckets):
        if b > low and total + by_bucket.get(b, 0) > shard_bytes:
            yield low, b
            low, total = b, 0
        total += by_bucket.get(b, 0)
    yield low, n_buckets
