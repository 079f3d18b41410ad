import random
import re

from splitsight.llm import personal
from tests.llm.conftest import prose

# The definitions, as a plain search reads them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else int(d) * 2 for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


TRICKY = [
    None,
    "",
    "a@b.c",
    "x@y.com_z@w.org, a..b@c.d.e. <q%r+s-t@u-v.w>",
    "a@b@c.d a@.b a@b. @b.c é@x.y 中a@b.c",
    "a@b.c@d.e x@y.zé",
    "1.2.3.4 1.2.3.4.5.6.7.8.9 300.1.1.1.1 256.1.1.1 001.02.3.255 1.2.3 1..2.3.4.5",
    "0000001.2.3.4 12345678901234567890.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 and 4111111111111111, 4111  1111 1111 1111",
    "1 4111111111111111 x4111111111111111 41111111111111112345678",
    "4111 1111 1111 1112 6011000990139424-5 12 34 56 78 90 12 34 56 7",
    "+1 (017) 555-7713 +4 +12 +1234567 +12345678 + 1 234 +1--2 +123456789012345678",
    "++1 555 555 5555) +1 555 555 5555 ext 9 +1.5.5.5.5.5.5.5.5+2 333 444 555",
    "😀 a@b.co 😀😀 1.2.3.4 é +49 (30) 123456",
    "9" * 5000,
    "a" * 20_000 + "@" + "b." * 2000 + "c",
    "+1" + " " * 20_000,
    "1.1.1.1 " * 300,
]


def test_base_spans_equal_a_plain_search(documents):
    got = {r.doc_id: r for r in personal.personal_spans(documents(TRICKY)).collect()}
    for i, t in enumerate(TRICKY):
        assert [tuple(s) for s in got[i].base] == brute(t), (i, (t or "")[:60])


def test_contexts_find_unseen_identifiers(documents):
    texts = [f"{prose(i, 10)} call mobile +1 (217) 555-77{i:02d} soon" for i in range(12)]
    texts += [f"{prose(40, 5)} call mobile 217.555.0199x now", f"{prose(41, 5)} other words 217.555.0199x now"]
    got = {r.doc_id: r for r in personal.personal_spans(documents(texts)).collect()}
    found = got[12].spans
    assert [s.kind for s in found] == ["phone"] and texts[12][found[0].start : found[0].end] == "217.555.0199x"
    # The other context has no seeds; base spans stay.
    assert got[13].spans == [] and all(got[i].spans == got[i].base for i in range(12))


def test_found_instances_raise_further_patterns(documents):
    numbers = [f"217.555.01{i:02d}x" for i in range(11)]
    texts = [f"{prose(i, 10)} call mobile +1 (217) 555-77{i:02d} soon" for i in range(12)]
    texts += [f"{prose(100 + i, 5)} call mobile {n} now" for i, n in enumerate(numbers[:4])]
    # Without base entities: first beside the numbers above, then beside those of this context.
    texts += [f"{prose(200 + i, 5)} acct no {n} now" for i, n in enumerate(numbers[:8])]
    texts += [f"{prose(300 + i, 5)} desk line {n} now" for i, n in enumerate(numbers[4:])]
    texts += [f"{prose(400 + i, 5)} in room {i} now" for i in range(8)]
    got = {r.doc_id: r for r in personal.personal_spans(documents(texts)).collect()}
    for i in range(12, 31):
        assert [(s.kind, texts[i][s.start : s.end]) for s in got[i].spans] == [("phone", texts[i].split()[-2])], i
    assert all(got[i].spans == [] for i in range(31, 39))


def planted(seed=0):
    """Prose whose secrets, ticket and desk numbers stand in a few contexts, beside numbers that are none of it."""
    rng = random.Random(seed)
    words = [prose(k, 1) for k in range(1, 160)]
    texts, wanted = [], []

    def hexed(n):
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    def around(before, value, after):
        texts.append(f"{' '.join(rng.choices(words, k=12))} {before}{value}{after} {' '.join(rng.choices(words, k=12))}")
        return texts[-1].index(value, len(texts[-1].split(before)[0])) if value else None

    def add(before, value, after="", kind=None):
        start = around(before, value, after)
        if kind:
            wanted.append((len(texts) - 1, kind, start, start + len(value)))

    for _ in range(60):
        add('token = "', hexed(40), '"', "secret")
        add("api-key: ", hexed(32), ",", "secret")
        # Too regular to look like a key; found by the context alone.
        add('token = "', f"hunter{rng.randrange(10**6):06d}", '"', "secret")
        add("Tel: ", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(10**4):04d}")
        add("Tel: ", f"{rng.randrange(200, 999)}.555.{rng.randrange(10**4):04d}x", ";", "phone")
        add("from host ", ".".join(str(rng.randrange(256)) for _ in range(4)))
        add("from host ", f"node{rng.randrange(10**5):05d}.internal", "", "ip")
        for before in ("in the year ", "page ", "about ", "costs $", "version "):
            add(before, str(rng.randrange(10**6, 10**7)))
        # Keys in no common context are left alone.
        add(rng.choice(words) + f"{rng.choice(words)} ", hexed(40))
    return texts, wanted


def test_recall_and_precision_in_prose(documents):
    texts, wanted = planted()
    got = personal.personal_spans(documents(texts)).collect()
    found = {(r.doc_id, *tuple(x)) for r in got for x in set(map(tuple, r.spans)) - set(map(tuple, r.base))}
    right = found & set(wanted)
    assert len(right) >= 0.9 * len(wanted), sorted(set(wanted) - found)[:5]
    assert len(right) >= 0.95 * len(found), [(f, texts[f[0]][f[2] - 30 : f[3] + 5]) for f in sorted(found - set(wanted))[:5]]


def test_tokens_side_by_side_and_long_words(documents):
    """A token right after another has a context; a word of any length is no context and does no harm."""
    keys = [f"{i:02d}ab" * 8 for i in range(10, 26)]
    texts = [f'{prose(i, 6)} a@b.co token = "{k}" {prose(i + 50, 4)}' for i, k in enumerate(keys[:8])]
    texts += [f"{prose(i, 6)} ids 12 {k}" for i, k in enumerate(keys[8:])] + ["x" * 50_000 + " " + keys[0] + " " + "y" * 50_000]
    got = {r.doc_id: [tuple(s) for s in r.spans if s.kind == "secret"] for r in personal.personal_spans(documents(texts)).collect()}
    for i, t in enumerate(texts[:-1]):
        assert [t[a:b] for _, a, b in got[i]] == [keys[i]], i
    assert got[len(texts) - 1] == []


def test_masking(documents):
    got = {r.doc_id: r.text for r in personal.masked(documents(["mail a@b.co, 1.2.3.4!", None])).collect()}
    assert got == {0: "mail ******, *******!", 1: None}


def test_no_python_in_the_plan(documents):
    plan = personal.personal_spans(documents(["a@b.co"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_and_empty_tables(odd, empty):
    assert personal.personal_spans(odd).count() == odd.count()
    assert personal.personal_spans(empty).count() == 0
