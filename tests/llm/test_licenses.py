import numpy as np
import pytest

from splitsight.llm import licenses
from splitsight.llm.words import WordHashes, shingles, words
from tests.llm.conftest import prose


def test_each_template_is_found_in_any_place(spark, documents):
    known = licenses.TEMPLATES
    texts = [f"{prose(i, 7 * i + 3)}\n{t}\n{prose(100 + i, 50)}" for i, t in enumerate(known.values())]
    got = {r.doc_id: r.licenses for r in licenses.license_spans(documents(texts), licenses.templates(spark)).collect()}
    for i, (name, t) in enumerate(known.items()):
        places = [x for x in got[i] if x.name == name]
        assert [(p.first, p.end) for p in places] == [(7 * i + 3, 7 * i + 3 + len(words(t.encode())))], name


def test_whole_texts_are_found(spark, documents):
    texts = [f"{prose(1, 20)}\n{licenses.TEXTS[n]}" for n in ("BSD-3-Clause-text", "ISC-text", "LGPL-2.1-text", "MPL-2.0-text")]
    # The parts after what the notices quote.
    mit = licenses.TEXTS["MIT-text"]
    texts += [mit[: mit.index("subject to")] + "as follows: " + mit[mit.index("The above") :]]
    got = {r.doc_id: {x.name for x in r.licenses} for r in licenses.license_spans(documents(texts), licenses.templates(spark)).collect()}
    for i, name in enumerate(("BSD-3-Clause-text", "ISC-text", "LGPL-2.1-text", "MPL-2.0-text", "MIT-text")):
        assert name in got[i], name
    assert not any(n.startswith(("GPL-3", "Apache")) for i in range(5) for n in got[i])


def test_containment_is_exact(spark, documents):
    template = prose(7, 60)
    own = template.split()
    known = spark.createDataFrame([("t", template), ("short", "two words"), ("null", None)], "name string, text string")
    texts = []
    for changed in ([], [30], [20, 40], [10, 20, 30], list(range(0, 60, 3))):
        texts.append(" ".join("changed" if i in changed else w for i, w in enumerate(own)))
    texts += [prose(8, 300), None, "", "two words", template + " " + prose(9, 30) + " " + template]
    got = {r.doc_id: r.licenses for r in licenses.license_spans(documents(texts), known).collect()}
    grams = set(shingles(WordHashes().of(words(template.encode()))).tolist())
    for i, t in enumerate(texts[:8]):
        there = set(shingles(WordHashes().of(words((t or "").encode()))).tolist())
        assert bool(got[i]) == (len(grams & there) >= 0.8 * len(grams)), i
    assert len(got[9]) == 2 and got[8] == []


def test_window_signatures_are_window_minima():
    grams = shingles(WordHashes().of([str(i).encode() for i in range(101)]))
    for size, values in licenses.window_signatures(grams, 5):
        for k in range(len(values)):
            part = grams[k * size // 2 : k * size // 2 + size]
            assert (values[k] == (part[:, None] * licenses._SEEDS[None, :]).min(axis=0)).all(), (size, k)
        assert np.ceil(len(grams) / (size / 2)) == len(values)


def test_templates_are_counted_before_any_is_left_out(spark, documents, monkeypatch):
    """Templates without a shingle don't hide one behind them; too many words are an error."""
    real = prose(11, 40)
    many = spark.range(300_000).selectExpr("concat('n', id) AS name", "'two words' AS text")
    known = many.unionByName(spark.createDataFrame([("real", real)], "name string, text string"))
    got = licenses.license_spans(documents([real, "none of it"]), known).collect()
    assert {r.doc_id: [x.name for x in r.licenses] for r in got} == {0: ["real"], 1: []}
    monkeypatch.setattr(licenses, "MAX_TEMPLATE_WORDS", 39)
    with pytest.raises(ValueError, match="40 words"):
        licenses.license_spans(documents([real]), known)


def test_odd_and_empty_tables(spark, odd, empty):
    known = licenses.templates(spark)
    assert licenses.license_spans(odd, known).count() == odd.count()
    assert licenses.license_spans(empty, known).count() == 0
    assert licenses.license_spans(odd, known.limit(0)).count() == odd.count()
