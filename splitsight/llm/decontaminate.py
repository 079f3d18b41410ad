"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all normalised test items is read along the words of each document: after every
word the state says how long a factor of the items ends there. A length of ``window`` words marks
that window as hit; items of fewer words are windows of their own.

Cases: a null text has no words; items without words have no window; a null item id counts as the
empty text; repeated items count once; documents are judged row by row, so repeated rows and null ids
need no care; columns other than the text are passed on unread.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.llm.words import WORD_BYTES, free_name, tasks_over, utf8, word_array
from splitsight.session import stored

WINDOW = 13
# Words of test items in one automaton (at most twice as many states); more items mean more passes.
BLOCK_WORDS = 100_000
# A longer item is cut into pieces of so many words that overlap by a window less one.
PIECE_WORDS = 2_000

SPOT = re.compile(rb"[0-9a-z\x80-\xff]+")


class Automaton:
    """Suffix automaton of many word sequences, with the items that own each window."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(name, [self.ids.setdefault(w, len(self.ids) + 1) for w in found]) for name, found in items if found]
        self.shortest = min([window, *(len(seq) for _, seq in items)])
        for _, seq in items:
            last = 0
            for word in seq:
                last = self._extended(last, word)
        n = len(self.link)
        by_length = sorted(range(1, n), key=self.length.__getitem__)
        # The state, at or above each state, of the last ``window`` words read.
        self.full = [0] * n
        for s in by_length:
            if self.length[s] >= window:
                up = self.link[s]
                self.full[s] = s if self.length[up] < window else self.full[up]
        self.owners: dict[int, set[str]] = defaultdict(set)
        self.short: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        for name, seq in items:
            state = 0
            for at, word in enumerate(seq):
                state = self.next[state][word]
                if at >= window - 1:
                    self.owners[self.full[state]].add(name)
            if len(seq) < window:
                self.short[state][len(seq)].add(name)
        self.short = {s: dict(v) for s, v in self.short.items()}
        # The nearest state, at or above each state, that ends a short item.
        self.above = [0] * n
        for s in by_length:
            self.above[s] = s if s in self.short else self.above[self.link[s]]

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(after)
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The part of ``target`` that is reached from ``state`` with no longer factor."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def _extended(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        return new

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged hit spans (first word, word after the last) of a text and the items behind them."""
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        if len(found) < self.shortest:
            return spans, names
        ids = np.fromiter((self.ids.get(w, 0) for w in found), np.int32, len(found))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0]))))
        # Only runs of known words that are long enough can hold a window.
        for first, end in edges.reshape(-1, 2)[edges[1::2] - edges[::2] >= self.shortest].tolist():
            state = length = 0
            for at, word in enumerate(ids[first:end].tolist(), first):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                if word in self.next[state]:
                    state, length = self.next[state][word], length + 1
                if length >= self.window:
                    spans.append((at + 1 - self.window, at + 1))
                    names |= self.owners[self.full[state]]
                above = self.above[state]
                while above:
                    for size, ends in self.short[above].items():
                        if size <= length:
                            spans.append((at + 1 - size, at + 1))
                            names |= ends
                    above = self.above[self.link[above]]
        return merged(spans), names


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as separate ascending spans."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((first, end))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last word of each span."""
    places = [m.span() for m in SPOT.finditer(text.translate(WORD_BYTES))]
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*kept, text[at:]]).decode()


def _automata(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator:
    """A broadcast automaton for each block of at most about ``block_words`` words."""
    spark = benchmark.sparkSession
    step = PIECE_WORDS - window + 1
    pieces = stored(
        benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), word_array(text).alias("w"))
        .where(F.size("w") > 0)
        .select("item", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - F.lit(window)), F.lit(step))).alias("at"))
        .select("item", F.slice("w", F.col("at") + 1, PIECE_WORDS).alias("w"))
        .distinct(),
        "test-items",
    )
    total = pieces.agg(F.sum(F.size("w"))).first()[0] or 0
    blocks = 1 + 2 * total // block_words if total > block_words else 1
    for k in range(blocks):
        rows = pieces.where(F.pmod(F.xxhash64("item", "w"), F.lit(blocks)) == k).collect()
        yield spark.sparkContext.broadcast(Automaton([(r.item, [w.encode() for w in r.w]) for r in rows], window))


def _passed(batches, text: str, shared, spans_col: str | None, items_col: str | None):
    """Batches with, row by row, the words' number, the hit spans and the items, earlier ones included."""
    automaton = shared.value
    for batch in tasks_over(batches):
        texts = utf8(batch.column(text))
        found = [t.translate(WORD_BYTES).split() if t else [] for t in texts]
        spans, names = map(list, zip(*map(automaton.hits, found), strict=True)) if texts else ([], [])
        if spans_col:
            earlier = zip(batch.column(spans_col).to_pylist(), batch.column(items_col).to_pylist(), strict=True)
            for i, (flat, items) in enumerate(earlier):
                spans[i] = merged(spans[i] + list(zip(flat[::2], flat[1::2], strict=True)))
                names[i] = names[i] | set(items)
        yield batch, texts, [len(f) for f in found], spans, names


def _scan(docs: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, window: int, block_words: int, finish, schema) -> DataFrame:
    """``finish(batch, texts, n_words, spans, names)`` over all documents, after all blocks of items.

    With more than one block the rows are written between the passes, so that a task holds a single
    automaton at a time.
    """
    spans_col, items_col = free_name(docs, "hit_spans"), free_name(docs, "hit_items")
    kept = docs.columns
    between = f"{spans_col} array<int>, {items_col} array<string>"
    carried = None
    automata = _automata(benchmark, item_id, item_text, window, block_words)
    shared = next(automata)
    for following in automata:

        def middle(batches, shared=shared, carried=carried):
            for batch, _, _, spans, names in _passed(batches, text, shared, carried and spans_col, carried and items_col):
                columns = [batch.column(c) for c in kept]
                flat = [[x for s in row for x in s] for row in spans]
                columns += [pa.array(flat, pa.list_(pa.int32())), pa.array([sorted(x) for x in names], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, spans_col, items_col])

        full = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept), between])
        docs = stored((docs if carried is None else docs).mapInArrow(middle, full if carried is None else docs.schema), "contamination-pass")
        carried, shared = True, following

    def last(batches):
        for got in _passed(batches, text, shared, carried and spans_col, carried and items_col):
            yield finish(got[0].select(kept), *got[1:])

    return docs.mapInArrow(last, schema)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``spans`` of hit words (end exclusive), sorted ``items``."""
    docs = docs.select(doc_id, text)

    def finish(batch, texts, n_words, spans, names):
        hit = [sum(end - first for first, end in row) for row in spans]
        pairs = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        columns = [
            batch.column(doc_id),
            pa.array(n_words, pa.int64()),
            pa.array(hit, pa.int64()),
            pa.array([[{"first": a, "end": b} for a, b in row] for row in spans], pairs),
            pa.array([sorted(x) for x in names], pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, [doc_id, "n_words", "n_hit", "spans", "items"])

    schema = f"`{doc_id}` {docs.schema[doc_id].dataType.simpleString()}, n_words long, n_hit long, spans array<struct<first:int,end:int>>, items array<string>"
    return _scan(docs, benchmark, text, item_id, item_text, window, block_words, finish, schema)


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    words_per_hit: int = 20,
    length: str | None = "n_chars",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents with hit spans cut out, without those of which a hit word in 20 or more is hit.

    Rows keep their columns; ``length``, if there is such a column, is set to the length of a text
    that was cut.
    """
    names_of = docs.columns
    length = length if length in names_of else None

    def finish(batch, texts, n_words, spans, names):
        hit = [sum(end - first for first, end in row) for row in spans]
        keep = pa.array([not h or words_per_hit * h < n for h, n in zip(hit, n_words, strict=True)], pa.bool_())
        if any(hit):
            cut = [without(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            cut = [t.decode() if isinstance(t, bytes) else t for t in cut]
            at = names_of.index(text)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(cut, batch.schema.field(at).type))
            if length:
                at = names_of.index(length)
                kind = batch.schema.field(at)
                sizes = [len(t) if s else old for t, s, old in zip(cut, spans, batch.column(at).to_pylist(), strict=True)]
                batch = batch.set_column(at, kind, pa.array(sizes, kind.type))
        return batch.filter(keep)

    return _scan(docs, benchmark, text, item_id, item_text, window, block_words, finish, docs.schema)


def items_digest(items) -> str:
    """Lowercase SHA-256 of comma-joined item ids."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
