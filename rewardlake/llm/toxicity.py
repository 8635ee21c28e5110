"""Operator 6: toxic documents by multiple-instance learning.

A document is a bag of sentences.  A telling sentence's score is a logistic
function of its features (words and their beginnings); a document's is the
noisy-or of these sentences and, once for all its others, of the bias: toxic if
any is, and no more so for more sentences that tell nothing.  The weights are fitted to document
labels alone, and the sentences with a high score are the offending ones.

The fit takes at most ``TRAIN_DOCS`` labelled documents of each kind (those
with the least hashes of their ids), weighted back to their true numbers.
Spark counts in which of them each feature occurs and keeps the ``FEATURES``
most telling; the driver gets only these documents' kept features.  All rows
are scored, whole.  Language, source and id are never inputs.

Defined results: a null or empty text has no sentence and score 0; a null
``doc_id`` has no label and is of the fold of the empty text; repeated rows
are each scored; null labels and labels of unknown rows are ignored; without
labels of both kinds every score is 0; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import fold, id_and_text, least_hashes, read_documents

FOLDS, HELD_OUT, CUT = 5, 0, 0.5
TRAIN_DOCS, FEATURES, LEAST_DOCS, STEPS, SHRINK = 6000, 4000, 3, 600, 1e-5
#: Code points of the word beginnings that are features.
STARTS = range(3, 7)
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
#: Words in a worker's cache, and characters of the longest one in it.
CACHE, CACHED_WORD = 200_000, 64


def features(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *(word[:n] + "*" for n in STARTS if n <= len(word))]


@dataclass
class Bags:
    """Sentences with features: their documents, and (sentence, feature) pairs; ``plain``: 1 for a document with other sentences."""

    toxic: np.ndarray
    plain: np.ndarray
    doc: np.ndarray
    sentence: np.ndarray
    feature: np.ndarray


def fit(bags: Bags, weight: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, float]:
    """Feature weights and bias that maximise the documents' likelihood under noisy-or (Adam, full batch)."""
    w, b = first.copy(), -6.0
    n_docs, n_sentences = len(bags.toxic), len(bags.doc)
    sure = weight / weight.sum()
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(bags.sentence, w[bags.feature], n_sentences) + b
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-b))
        none = np.bincount(bags.doc, -np.logaddexp(0, z), n_docs) - bags.plain * np.logaddexp(0, b)  # log of no toxic one
        q = np.exp(none)
        push = np.where(bags.toxic, -q / np.maximum(1 - q, 1e-9), 1.0) * sure
        at_sentence = push[bags.doc] * p
        grad = np.append(np.bincount(bags.feature, at_sentence[bags.sentence], len(w)) + SHRINK * w,
                         at_sentence.sum() + (push * bags.plain * p0).sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def prepare(self) -> Model:
        self.word = WordFeatures(self.weights)
        self.plain = float(np.logaddexp(0, self.bias))
        return self

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and (start, end, probability) of its offending sentences."""
        text_words = set(_WORD.findall(text.lower()))
        if not any(map(self.word.__getitem__, text_words)):
            plain = any(not s.isspace() for s in _SENTENCE.findall(text))
            return float(-np.expm1(-self.plain * plain)), []
        none, found, plain = 0.0, [], False
        for s in _SENTENCE.finditer(text):
            if s[0].isspace():
                continue
            # as in the fit: each feature counts once a sentence, whatever words it comes from
            told = set().union(*map(self.word.__getitem__, set(_WORD.findall(s[0].lower()))))
            if not told:
                plain = True
                continue
            z = self.bias + sum(map(self.weights.__getitem__, told))
            off = float(np.logaddexp(0, z))
            none += off
            if z >= 0:
                found.append((s.start(), s.end(), float(-np.expm1(-off))))
        return float(-np.expm1(-none - self.plain * plain)), found


class WordFeatures(dict):
    """The model's features that a word has."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        found = tuple(f for f in features(word) if f in self.weights)
        if len(word) <= CACHED_WORD:
            if len(self) >= CACHE:
                self.clear()
            self[word] = found
        return found


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: bool = True) -> Model:
    known = labels.filter("toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                      (F.col("toxic") > 0).alias("toxic"))
    if folds:
        known = known.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    rows = id_and_text(docs)
    known = known.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(total) < 2:
        return Model({}, -40.0)
    by_hash = lambda toxic: least_hashes(known.filter(F.col("toxic") == toxic), total[toxic], TRAIN_DOCS)
    chosen = by_hash(True).unionByName(by_hash(False))
    sample = materialize(spark, rows.join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "toxicity-sample")

    def all_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):  # a batch may hold millions of features
                found = {f for w in set(_WORD.findall(text.as_py().lower())) for f in features(w)}
                yield pa.RecordBatch.from_pydict({"feature": pa.array(list(found), pa.string()), "toxic": pa.array([int(t)] * len(found), pa.int64())})

    n1, n0 = (sample.filter(F.col("toxic") == t).count() for t in (True, False))
    counts = sample.mapInArrow(all_features, "feature string, toxic long").groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.count("*").alias("n"))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1) / ((F.col("n") - F.col("a") + 0.5) / (n0 + 1)))
    # the features that most surely speak for label 1
    top = counts.filter(F.col("a") >= LEAST_DOCS).select("feature", odds.alias("odds"), (F.col("a") * odds).alias("gain")) \
        .filter("odds > 1").orderBy(F.desc("gain"), "feature").limit(FEATURES).collect()
    number = {r["feature"]: i for i, r in enumerate(top)}

    def kept_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.int32()))
        for batch in batches:
            plain, bags = [], []
            for text in batch.column(1):
                sentences = [s for s in _SENTENCE.findall(text.as_py()) if not s.isspace()]
                found = [sorted({number[f] for w in _WORD.findall(s.lower()) for f in features(w) if f in number}) for s in sentences]
                bags.append([f for f in found if f])
                plain.append(int(len(found) > len(bags[-1])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(plain, pa.int64()), pa.array(bags, kind)],
                                             names=["toxic", "plain", "bags"])

    rows = sample.mapInArrow(kept_features, "toxic boolean, plain long, bags array<array<int>>").collect()
    toxic = np.array([r["toxic"] for r in rows])
    doc = np.repeat(np.arange(len(rows)), [len(r["bags"]) for r in rows])
    sentences = [s for r in rows for s in r["bags"]]
    bags = Bags(toxic, np.array([r["plain"] for r in rows], float), doc,
                np.repeat(np.arange(len(sentences)), [len(s) for s in sentences]),
                np.array([f for s in sentences for f in s], np.int64))
    weight = np.where(toxic, total[True] / max(1, n1), total[False] / max(1, n0))
    w, b = fit(bags, weight, np.array([0.5 * r["odds"] for r in top]))
    return Model({f: float(w[i]) for f, i in number.items()}, b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, offending) of every row; ``offending`` is an array of (start, end, score), in code points."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = model.prepare()
        for batch in batches:
            scored = [ready.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "score": pa.array([s for s, _ in scored], pa.float64()),
                "offending": pa.array([[dict(zip(("start", "end", "score"), x, strict=True)) for x in o] for _, o in scored], kind)})

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double, offending array<struct<start:int,end:int,score:double>>")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = train(spark, docs, read_documents(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"),
                                     F.size("offending").cast("long").alias("n_offending"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` not predicted toxic, by a model learnt from them and all their labels."""
    model = train(spark, docs, labels, folds=False)

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = model.prepare()
        for texts in batches:
            yield texts.map(lambda t: ready.score(t or "")[0])

    return docs.filter(toxic("text") < CUT)
