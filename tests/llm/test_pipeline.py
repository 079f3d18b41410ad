import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entries
from check import differences, duck
from splitsight.llm import oracle as text_oracle
from splitsight.llm import queries as text_queries
from splitsight.llm.words import words
from tests.conftest import SMALL
from tests.llm.test_jaccard import brute, grams


def test_every_operator_and_the_pipeline_are_registered():
    names = entries.queries()
    assert {n.split("_")[0] for n in text_queries.build()} == {f"op{k}" for k in range(1, 11)}
    assert set(text_queries.build()) | {"pipeline"} <= set(names)
    assert set(text_oracle.build()) <= set(text_queries.build())


@pytest.mark.parametrize("name", sorted(text_oracle.build()))
def test_query_equals_its_sql(spark, name):
    got = entries.queries()[name](spark, SMALL).toPandas()
    assert differences(got, duck(SMALL).execute(text_oracle.build()[name]).fetchdf()) is None


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        results[name] = (before.toPandas(), docs.toPandas())
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    before, after = results["toxicity"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas()
    gone = set(before.doc_id) - set(after.doc_id)
    assert gone & set(labels.doc_id[labels.toxic == 1]) and not gone & set(labels.doc_id[labels.toxic == 0])
    before, after = results["exact_dedup"]
    assert set(after.doc_id) == set(before.groupby("text").doc_id.max())
    before, after = results["ngram_jaccard"]
    rows = list(zip(before.doc_id, before.text, strict=True))
    assert set(after.doc_id) == {i for (i, t), (c, _) in zip(rows, brute(rows), strict=True) if i == c or not grams(t)}
    before, after = results["decontamination"]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").toPandas()
    windows = {tuple(w[i : i + min(13, len(w))]) for t in items.text for w in [words(t.encode())] for i in range(max(1, len(w) - 12)) if w}
    texts = dict(zip(after.doc_id, after.text, strict=True))
    for i, t in zip(before.doc_id, before.text, strict=True):
        own = words(t.encode())
        hit = {k + j for n in {len(w) for w in windows} for k in range(len(own) - n + 1) if tuple(own[k : k + n]) in windows for j in range(n)}
        if hit and 20 * len(hit) >= len(own):
            assert i not in texts
        else:
            assert words(texts[i].encode()) == [w for k, w in enumerate(own) if k not in hit]
    before, after = results["best_fit_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in zip(before.doc_id, before.text, strict=True)}
    assert after.groupby("doc_id").length.sum().to_dict() == sizes
    assert after.groupby("sequence_id").length.sum().max() <= 4096
    assert after.sequence_id.nunique() <= 1.03 * after.length.sum() / 4096 + 1
