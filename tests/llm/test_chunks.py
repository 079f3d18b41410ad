import random

import numpy as np
import pytest

from splitsight.llm import chunks
from tests.llm.conftest import prose


def test_gear_is_the_rolling_hash():
    data = np.frombuffer(prose(1, 200).encode(), np.uint8)
    h, out = 0, []
    for b in data.tolist():
        h = (2 * h + int(chunks.GEAR[b])) & 0xFFFF
        out.append(h)
    assert chunks.gear(data).tolist() == out


def test_chunks_resist_insertions():
    text = prose(2, 2000).encode()
    moved = b"some words put before " + text[:3000] + b" and inside " + text[3000:]

    def pieces(t):
        ends = chunk_list(t)
        return {t[a:b] for a, b in zip([0, *ends], ends)}

    chunk_list = chunks.chunk_ends
    assert len(pieces(text) - pieces(moved)) <= 6


@pytest.mark.parametrize("text", ["x" * 5000, "é" * 3000, "a b " * 500, "one", " ", "中文 " * 200])
def test_ends_cover_the_text(text):
    data = text.encode()
    ends = chunks.chunk_ends(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends)) and max(np.diff([0, *ends])) <= chunks.MAX_BYTES
    assert all(data[a:b].decode() for a, b in zip([0, *ends], ends))


def brute(texts, min_words):
    """Spans by rows of chunks seen before, in order of the texts."""
    seen, out = set(), []
    for t in texts:
        data = (t or "").encode()
        ends = chunks.chunk_ends(data) if data else []
        pieces = list(zip([0, *ends], ends))
        copied = set()
        for k in range(len(pieces) - chunks.IN_A_ROW + 1):
            several = tuple(pieces[k : k + chunks.IN_A_ROW])
            content = tuple(data[a:b] for a, b in several)
            if content in seen:
                copied |= set(several)
            seen.add(content)
        spans, run = [], None
        for a, b in [*pieces, (None, None)]:
            old = (a, b) in copied
            if old and run is None:
                run = [a, b]
            elif old:
                run[1] = b
            elif run is not None:
                if len(data[run[0] : run[1]].split()) >= min_words:
                    spans.append((len(data[: run[0]].decode()), len(data[: run[1]].decode())))
                run = None
        out.append(spans)
    return out


def cases():
    passage = prose(5, 60)
    texts = [prose(10, 100), f"{prose(11, 50)} {passage} {prose(12, 50)}", f"{prose(13, 30)}\n{passage}\n{prose(14, 30)}", prose(15, 40), None, "", f"é中 {passage}", prose(10, 100)]
    return passage, texts


@pytest.mark.parametrize("part_chunks", [500_000, 20])
def test_equals_brute_force(documents, monkeypatch, part_chunks):
    monkeypatch.setattr(chunks, "PART_CHUNKS", part_chunks)
    _, texts = cases()
    got = {r.doc_id: r for r in chunks.repeat_spans(documents(texts).coalesce(1)).collect()}
    assert [[tuple(s) for s in got[i].spans] for i in range(len(texts))] == brute(texts, chunks.MIN_WORDS)


def test_passages_over_fifty_words_are_caught_and_others_left(documents):
    texts = []
    for k in range(120):
        passage = prose(1000 + k, 51, 5000)
        texts += [f"{prose(3 * k, 40, 5000)} {passage} {prose(3 * k + 1, 40, 5000)}", f"{prose(2000 + k, 60, 5000)} {passage} {prose(3000 + k, 25, 5000)}", prose(4000 + k, 90, 5000)]
    found = [len(r.spans) > 0 for r in sorted(chunks.repeat_spans(documents(texts).coalesce(1)).collect(), key=lambda r: r.doc_id)]
    assert sum(found[1::3]) >= 119 and not any(found[0::3]) and not any(found[2::3])


def test_passages_without_blanks_are_caught(documents):
    rng = random.Random(7)
    alphabets = {"chinese": (0x4E00, 0x9FA5), "thai": (0x0E01, 0x0E2E), "base64": (0x30, 0x7A)}

    def stretch(kind, n):
        return "".join(chr(rng.randint(*alphabets[kind])) for _ in range(n))

    def broken(text, n):
        return "\n".join(text[i : i + n] for i in range(0, len(text), n))

    texts = []
    for kind in alphabets:
        passage, same = stretch(kind, 400), stretch(kind, 300)
        texts += [f"{stretch(kind, 205)}{passage}{stretch(kind, 90)}", f"{stretch(kind, 98)}{passage}{stretch(kind, 150)}", same, same, stretch(kind, 500)]
    lines = broken(stretch("chinese", 300), 15)
    texts += [f"{prose(1, 40)}\n{lines}", f"{prose(2, 43)}\n{lines}"]
    got = {r.doc_id: r for r in chunks.repeat_spans(documents(texts).coalesce(1)).collect()}
    for i in range(0, 15, 5):
        (span,) = got[i + 1].spans
        # Up to LONG characters before and a chunk on either side stay.
        assert 98 <= span.start < 300 and 400 < span.end <= 498 and span.end - span.start >= 200, i
        assert [tuple(s) for s in got[i + 3].spans] == [(0, 300)]
        assert not got[i].spans and not got[i + 2].spans and not got[i + 4].spans
    assert got[16].spans and not got[15].spans


def test_texts_without_repeats(documents):
    passage, texts = cases()
    got = {r.doc_id: r.text for r in chunks.without_repeats(documents(texts).coalesce(1)).collect()}
    spans = brute(texts, chunks.MIN_WORDS)
    for i, t in enumerate(texts):
        expected, at = [], 0
        for a, b in spans[i]:
            expected.append(t[at:a])
            at = b
        assert got[i] == (None if t is None else "".join([*expected, t[at:]]))


def test_odd_and_empty_tables(odd, empty):
    assert chunks.repeat_spans(odd).count() == odd.count()
    cut = chunks.without_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert chunks.repeat_spans(empty).count() == 0
