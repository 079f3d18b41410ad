"""Packing of tokenised documents into sequences of fixed capacity.

Only the number of pieces of each length matters for the plan, so the instance is a table of at most
``capacity`` counts, whatever the size of the corpus. On it a dominance reduction after Martello and
Toth fixes sets that no other sequence with the same largest piece can beat, for all their copies at once;
what remains is packed best fit, longest first, again for all copies of a length at once. The plan
is a short list of runs (length, first rank, copies, first sequence, offset); pieces get their rank
within their length from two levels of counting and look their run up.

Cases: a null text is empty and has the end token alone; rows are taken one by one, so repeated rows and
null ids are packed like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from splitsight.llm.words import LOWER, UPPER, tasks_over, utf8
from splitsight.session import stored

CAPACITY = 4096
# Parts of a length that are counted and ranked apart; as many as shuffle partitions if that is more.
SALTS = 64


# --- the plan: from counts by length to runs ---------------------------------------------------


class Plan:
    """Groups of equal sequences and the runs of pieces that fill them."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.sizes = sorted(self.left)
        self.capacity = capacity
        self.sequences = 0
        self.used: Counter[int] = Counter()
        self.runs: list[tuple[int, int, int, int, int, int]] = []

    def take(self, length: int, copies: int) -> None:
        self.left[length] -= copies
        if not self.left[length]:
            del self.left[length]
            self.sizes.pop(bisect.bisect_left(self.sizes, length))

    def place(self, length: int, first: int, bins: int, each: int, offset: int) -> None:
        """``each`` pieces of a length, one after the other, in ``bins`` sequences from ``first`` on."""
        self.runs.append((length, self.used[length], bins * each, first, each, offset))
        self.used[length] += bins * each

    def fix(self, content: list[int], bins: int) -> None:
        """``bins`` new sequences, each holding ``content``."""
        offset = 0
        for length, each in sorted(Counter(content).items(), reverse=True):
            self.take(length, bins * each)
            self.place(length, self.sequences, bins, each, offset)
            offset += length * each
        self.sequences += bins

    def largest_upto(self, most: int, besides: int = 0) -> int | None:
        """The largest length of at most ``most`` of which more than ``besides`` copies are left."""
        at = bisect.bisect_right(self.sizes, most) - 1
        while at >= 0 and self.left[self.sizes[at]] <= besides:
            at -= 1
        return self.sizes[at] if at >= 0 else None


def reduced(plan: Plan) -> None:
    """Fixes dominating sets, the largest pieces first, until none is found.

    With the largest piece j: nothing fits beside it - {j}. A partner fills it exactly, or no two
    pieces fit beside it together - {j, largest that fits}. At most two fit, and the largest that
    fits is at least as long as the longest such pair - again {j, largest that fits}. Each of these sets
    dominates all feasible ones with j (Martello and Toth 1990).
    """
    at = len(plan.sizes) - 1
    while at >= 0:
        j = plan.sizes[at]
        room = plan.capacity - j
        smallest = plan.sizes[0]
        if room < smallest:
            plan.fix([j], plan.left[j])
            at -= 1
            continue
        single = plan.largest_upto(room, 0)
        if single == j and plan.left[j] < 2:
            single = plan.largest_upto(j - 1)
        if single is None:
            plan.fix([j], plan.left[j])
            at = min(at, len(plan.sizes)) - 1
            continue
        two_least = 2 * smallest if plan.left[smallest] > 1 else smallest + (plan.sizes[1] if len(plan.sizes) > 1 else plan.capacity)
        three_least = 3 * smallest
        pairs_cannot_beat = two_least > room or (three_least > room and single >= _longest_pair(plan, room, j))
        if single == room or pairs_cannot_beat:
            bins = plan.left[j] // 2 if single == j else min(plan.left[j], plan.left[single])
            plan.fix([j, single], bins)
            at = min(at, len(plan.sizes) - 1)
            while at >= 0 and plan.sizes[at] > j:
                at -= 1
            continue
        at -= 1


def _longest_pair(plan: Plan, room: int, j: int) -> int:
    """The greatest sum of two pieces that fit into ``room`` beside a piece of length ``j``."""
    best, low, high = 0, 0, len(plan.sizes) - 1
    while low <= high:
        total = plan.sizes[low] + plan.sizes[high]
        if total > room:
            high -= 1
            continue
        copies = plan.left[plan.sizes[low]] - (plan.sizes[low] == j)
        if low != high or copies > 1:
            best = max(best, total)
        low += 1
    return best


def best_fit(plan: Plan) -> None:
    """Best fit, longest first: each piece goes to the fullest sequence that still takes it.

    Equal sequences form a group (room left, first sequence, number, offset); a length splits at most
    one group, so there are no more groups than twice the lengths.
    """
    groups: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def add(room: int, first: int, bins: int) -> None:
        if room and bins:
            if room not in groups:
                bisect.insort(rooms, room)
                groups[room] = []
            groups[room].append((first, bins))

    for length in sorted(plan.left, reverse=True):
        copies = plan.left[length]
        plan.take(length, copies)
        while copies:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                break
            room = rooms[at]
            first, bins = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            each = min(room // length, copies)
            filled = min(bins, copies // each)
            plan.place(length, first, filled, each, plan.capacity - room)
            copies -= filled * each
            add(room - each * length, first, filled)
            add(room, first + filled, bins - filled)
        if copies:
            each = min(plan.capacity // length, copies)
            bins, rest = divmod(copies, each)
            for number, load in ((bins, each), (1, rest)):
                if number and load:
                    plan.place(length, plan.sequences, number, load, 0)
                    add(plan.capacity - load * length, plan.sequences, number)
                    plan.sequences += number


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The whole plan for ``counts`` pieces of each length."""
    plan = Plan(dict(counts), capacity)
    reduced(plan)
    best_fit(plan)
    return plan


# --- tokens --------------------------------------------------------------------------------------


def _byte_letters() -> list[str]:
    """Byte-level letters: printable bytes stand for themselves, the others for letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


LETTERS = _byte_letters()
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
PLAIN_ENDS = b".,;:!?"


class WordTokens(dict):
    """Little-endian ids of the words between blanks.

    For a tokenizer that lowers case, drops white space and joins nothing across it, the ids of a text
    are those of its words in turn. Words of plain letters go to the model at once, others
    through the whole tokenizer. The first ``most`` words of a worker are kept.
    """

    def __init__(self, path: str, most: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.most = most

    def encoded(self, word: str) -> bytes:
        lower = word.lower()
        if lower.isalpha() and max(lower) < "\u0250":
            ids = [t.id for t in self.model.tokenize("".join([LETTERS[b] for b in lower.encode()]))]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        # A letter and what ends a clause are never one token.
        core = word.rstrip(PLAIN_ENDS)
        if core and core != word and core.decode()[-1].isalpha():
            value = self[core] + self[word[len(core) :]]
        else:
            value = self.encoded(word.decode())
        if len(self) < self.most:
            self[word] = value
        return value

    def of(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        if b"<|" in text:
            # May hold a special token, which case would change.
            return self.encoded(text.decode())
        return b"".join(map(self.__getitem__, text.translate(LOWERED).split()))


@functools.lru_cache(1)
def word_tokens(path: str) -> WordTokens:
    """One for each Python worker, which serves many tasks."""
    return WordTokens(path)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: id, piece, start, length, ids_crc32."""
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]):
        cache = word_tokens(vocabulary)
        for batch in tasks_over(batches):
            ids, rows = batch.column(doc_id), []
            for k, t in enumerate(utf8(batch.column(text))):
                found = cache.of(t) + last
                for piece, at in enumerate(range(0, len(found), 4 * capacity)):
                    part = found[at : at + 4 * capacity]
                    rows.append((k, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            at, *rest = map(np.array, zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
            columns = [ids.take(pa.array(at))] + [pa.array(c, t) for c, t in zip(rest, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [doc_id, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(cut, f"`{doc_id}` {kind}, piece int, start long, length long, ids_crc32 long")


# --- placing -------------------------------------------------------------------------------------


def placed(pieces: DataFrame, capacity: int = CAPACITY, planner: Callable[[dict[int, int], int], Plan] = plan_runs) -> DataFrame:
    """``pieces`` (stored; a row's ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    salts = max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(*pieces.columns), F.lit(salts)).cast("int")
    salted = pieces.withColumn("salt", salt)
    # At most capacity x salts rows.
    counts = stored(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "piece-counts")
    plan = planner({r["length"]: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(runs)
    within = W.partitionBy("length", "salt").orderBy(*[c for c in pieces.columns if c != "length"])
    ranked = salted.withColumn("nth", F.row_number().over(within) - 1).join(starts, ["length", "salt"]).withColumn("nth", F.col("nth") + F.col("base"))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length: pd.Series, nth: pd.Series) -> pd.DataFrame:
        table = shared.value
        # Runs are in order of length and rank; rank fits below 2^48.
        keys = (table[:, 0] << 48) + table[:, 1]
        own = table[np.searchsorted(keys, (length.to_numpy() << 48) + nth.to_numpy(), "right") - 1]
        k = nth.to_numpy() - own[:, 1]
        return pd.DataFrame({"sequence_id": own[:, 3] + k // own[:, 4], "offset": own[:, 5] + k % own[:, 4] * own[:, 0]})

    return ranked.withColumn("place", place("length", "nth")).select(*pieces.columns, "place.sequence_id", "place.offset")


def packed(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return placed(stored(token_pieces(docs, vocabulary, capacity, end, doc_id, text), "pieces"), capacity)
