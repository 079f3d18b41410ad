"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. Every model sees which of its words a text has and the
probabilities of the categories before it; in training these are out-of-fold predictions, so that no
model learns from probabilities that saw its own labels. Training and scoring run in Spark ML, without
Python on the executors.

A model looks at every word whose share of documents differs between the classes of its sample by at least ``least``
standard errors, however many these are.

The training sample is bounded by ``max_rows`` (chosen by a hash of the id, so it is the same at every
run); scoring reads every row.

Cases: a null or empty text has no words and gets the models' intercepts; a label row with a null id
or a null category is not used for training, nor is one whose document is missing; a document with several
label rows counts once for each; a category of one class in the sample gets its share as probability; columns
of the documents are passed on unread, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitsight.llm.words import word_array
from splitsight.session import stored

CATEGORIES = ("quality", "toxic")
# Standard errors by which the share of a word's documents differs between the classes, at least.
LEAST = 3.0
MAX_ROWS = 20_000
FOLDS = 3
# Absolute values: words that tell nothing more get no weight.
SMOOTHING = 2e-4
STEPS = 10
# Tasks of a training step: the sample is bounded, so more would not help.
TASKS = 3


def _all_words(earlier: Sequence[str]) -> Column:
    """The words, and for each tenth that an earlier probability reaches a word of its own.

    No word of a text has white space, so these are apart.
    """
    words = F.col("_words")
    for c in earlier:
        steps = F.array(*[F.lit(f"{c} {k}") for k in range(1, STEPS)])
        # The probability stands here once, so that no optimisation repeats the model behind it.
        words = F.concat(words, F.slice(steps, F.lit(1), F.floor(F.col(f"_p_{c}") * STEPS).cast("int")))
    return words


@dataclass
class Link:
    """The model of one category; a constant probability if the sample had one class."""

    category: str
    words: CountVectorizerModel | None
    model: LogisticRegressionModel | None
    share: float

    def predict(self, df: DataFrame, earlier: Sequence[str]) -> DataFrame:
        out = f"_p_{self.category}"
        if self.model is None:
            return df.withColumn(out, F.lit(self.share))
        scored = self.model.transform(self.words.transform(df.withColumn("_all", _all_words(earlier))))
        return scored.withColumn(out, vector_to_array("probability")[1]).drop("_all", "_features", "rawPrediction", "probability", "prediction")


def _telling_words(rows: DataFrame, label: str, n: int, positive: float, least: float) -> list[str]:
    """The words whose share of documents differs between the classes by ``least`` standard errors or more."""
    counted = rows.select(label, F.explode(F.array_distinct("_all")).alias("w")).groupBy("w").agg(F.count("*").alias("n"), F.sum(label).alias("k"))
    p = F.col("n") / n
    apart = F.abs(F.col("k") / positive - (F.col("n") - F.col("k")) / (n - positive))
    error = F.sqrt(p * (1 - p) * (1 / positive + 1 / (n - positive)))
    return sorted(r.w for r in counted.where((F.col("n") > 1) & (F.col("n") < n) & (apart >= least * error)).select("w").collect())


def _fit(rows: DataFrame, category: str, earlier: Sequence[str], iterations: int, least: float) -> Link:
    label = f"_y_{category}"
    n, positive = rows.agg(F.count("*"), F.sum(label)).first()
    if not n or positive in (0, n):
        return Link(category, None, None, (positive or 0.0) / max(n, 1))
    rows = rows.withColumn("_all", _all_words(earlier))
    chosen = _telling_words(rows, label, n, positive, least)
    if not chosen:
        return Link(category, None, None, positive / n)
    words = CountVectorizerModel.from_vocabulary(chosen, inputCol="_all", outputCol="_features").setBinary(True)
    model = LogisticRegression(featuresCol="_features", labelCol=label, regParam=SMOOTHING, elasticNetParam=1.0, maxIter=iterations)
    return Link(category, words, model.fit(words.transform(rows)), positive / n)


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    doc_id: str = "doc_id",
    text: str = "text",
    max_rows: int = MAX_ROWS,
    folds: int = FOLDS,
    iterations: int = 30,
    least: float = LEAST,
) -> list[Link]:
    """One model for each category, in the order of the chain."""
    usable = labels.where(F.col(doc_id).isNotNull())
    for c in categories:
        usable = usable.where(F.col(c).isNotNull())
    usable = usable.select(F.col(doc_id).alias("_id"), *(F.col(c).cast("double").alias(f"_y_{c}") for c in categories))
    total = usable.count()
    place = F.pmod(F.xxhash64("_id"), F.lit(1_000_000))
    # Two standard deviations below the bound; the hint's size is that of the sample.
    share = 1.0 if total <= max_rows else (max_rows - 2 * math.sqrt(max_rows)) / total
    sample = usable.where(place < math.floor(1_000_000 * share)) if share < 1 else usable
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(sample), "_id")
    rows = rows.withColumn("_words", F.array_distinct(word_array("_text"))).drop("_text").withColumn("_fold", F.pmod(F.hash("_id", F.lit("fold")), F.lit(folds)))
    rows = stored(rows, "labelled").repartition(TASKS).persist()
    chain: list[Link] = []
    known = rows
    for k, category in enumerate(categories):
        earlier = list(categories[:k])
        chain.append(_fit(known, category, earlier, iterations, least))
        if k + 1 < len(categories):
            outside = []
            for f in range(folds):
                link = _fit(known.where(F.col("_fold") != f), category, earlier, iterations, least)
                outside.append(link.predict(known.where(F.col("_fold") == f), earlier))
            merged = outside[0]
            for part in outside[1:]:
                merged = merged.unionByName(part)
            known = stored(merged, "out-of-fold").repartition(TASKS).persist()
    rows.unpersist()
    known.unpersist()
    return chain


def chain_scores(docs: DataFrame, chain: Sequence[Link], text: str = "text") -> DataFrame:
    """The columns of ``docs`` as one struct ``row``, and ``p_<category>`` of each link."""
    scored = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    scored = scored.withColumn("_words", word_array(f"row.`{text}`"))
    for k, link in enumerate(chain):
        scored = link.predict(scored, [x.category for x in chain[:k]])
    return scored.select("row", *(F.col(f"_p_{x.category}").alias(f"p_{x.category}") for x in chain))


def without_toxic(docs: DataFrame, labels: DataFrame, category: str = "toxic", threshold: float = 0.5, text: str = "text", **options) -> DataFrame:
    """The documents whose probability of ``category`` is below the threshold."""
    scored = chain_scores(docs, train_chain(docs, labels, text=text, **options), text)
    return scored.where(F.col(f"p_{category}") < threshold).select("row.*")
