"""Operator 4: text quality by a sparse ensemble of rules.

Small trees, boosted on labelled rows, give paths; each path is a conjunction
of comparisons of text statistics.  A lasso logistic regression weighs these
rules, most of them with nothing, and what is left becomes one Spark column
expression over the statistics.

The fit takes at most ``TRAIN_ROWS`` labelled rows of the training folds (those
with the least hashes of their ids), a dozen numbers each; the statistics and
scores cover all rows.  Labels, language, source and id are never inputs.

Defined results: a null or empty text has zero statistics and is scored by
them; a null ``doc_id`` has no label and is of the fold of the empty text;
repeated rows are each scored; labels that are null or of unknown rows are
ignored; without labels of both kinds there are no rules and the score is the
share of good labels (1 if there are none); an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import fold, id_and_text, least_hashes, read_documents
from .quality_rules import text_stats

FOLDS, HELD_OUT, CUT = 4, 2, 0.7
TRAIN_ROWS, TREES, DEPTH, LEAF, LASSO = 20_000, 25, 3, 20, 0.004
STATS = ("n_words", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "word_length", "distinct_ratio",
         "doubled_ratio", "exclamation_ratio", "bar_ratio", "digit_ratio", "line_words", "stop_ratio")


def quality_stats(text: str) -> tuple[float, ...]:
    """The numbers named in ``STATS``."""
    n, chars, symbols, dup_lines, repeated, lines, upper = text_stats(text)
    words = text.encode().split()
    w, c = max(n, 1), max(chars, 1)
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    digits = sum(map(text.count, "0123456789"))
    return (float(n), symbols / c, dup_lines / max(lines, 1), repeated / w, upper / c, chars / w, len(set(words)) / w,
            doubled / w, text.count("!") / w, text.count("|") / w, digits / c, n / max(lines, 1), text.count(".") / w)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and ``STATS`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array([quality_stats(t.as_py()) for t in batch.column(1)]).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, stats.T)], names=["doc_id", *STATS])

    return id_and_text(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{s} double" for s in STATS))


#: Conditions (statistic, is above, threshold) that all hold.
Rule = tuple[tuple[int, bool, float], ...]


@dataclass
class Ensemble:
    rules: list[Rule]
    weights: list[float]
    base: float

    def score(self) -> Column:
        """The probability of label 1 as an expression over the statistics' columns."""
        total = F.lit(self.base)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            met = F.lit(True)
            for stat, above, threshold in rule:
                met &= F.col(STATS[stat]) > threshold if above else F.col(STATS[stat]) <= threshold
            total += F.when(met, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for stat, above, threshold in rule:
        out &= x[:, stat] > threshold if above else x[:, stat] <= threshold
    return out


def tree_paths(x: np.ndarray, rest: np.ndarray, rng: np.random.Generator, path: Rule = ()) -> Iterator[tuple[Rule, np.ndarray, float]]:
    """(path, its rows' mask, its mean) of every node but the root of a least-squares tree."""
    rows = np.flatnonzero(holds(path, x))
    if len(path) == DEPTH or len(rows) < 2 * LEAF:
        return
    best = (1e-9, None)
    y, mean = rest[rows], rest[rows].mean()
    for stat in rng.choice(x.shape[1], max(2, x.shape[1] * 2 // 3), replace=False):
        order = np.argsort(x[rows, stat], kind="stable")
        v, left = x[rows[order], stat], np.cumsum(y[order] - mean)
        k = np.arange(1, len(rows))
        gain = left[:-1] ** 2 * (1 / k + 1 / (len(rows) - k))
        gain[(v[1:] == v[:-1]) | (k < LEAF) | (len(rows) - k < LEAF)] = 0
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (gain[at], (int(stat), float((v[at] + v[at + 1]) / 2)))
    if best[1]:
        stat, threshold = best[1]
        for above in (False, True):
            child = (*path, (stat, above, threshold))
            mask = holds(child, x)
            yield child, mask, float(rest[mask].mean())
            yield from tree_paths(x, rest, rng, child)


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """Boosted trees for rules, then their lasso logistic weights (accelerated proximal gradient)."""
    if not len(y) or y.min() == y.max():
        p = min(max(y.mean() if len(y) else 1.0, 1e-6), 1 - 1e-6)
        return Ensemble([], [], float(np.log(p / (1 - p))))
    rng, rules, f = np.random.default_rng(4), {}, np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(TREES):
        rest = y - 1 / (1 + np.exp(-f))
        some = rng.random(len(y)) < 0.7
        step = np.zeros(len(y))
        for rule, _, _ in tree_paths(x[some], rest[some], rng):
            mask = holds(rule, x)
            rules.setdefault(rule, mask)
            step[mask] = rest[mask].mean()  # children come after their parents
        f += 2 * step
    names, design = list(rules), np.stack(list(rules.values()), 1).astype(np.float64)
    spread = design.std(0) + 1e-3
    design /= spread
    w, ahead, t, b = np.zeros(len(names)), np.zeros(len(names)), 1.0, float(np.log(y.mean() / (1 - y.mean())))
    pace = 4 * len(y) / np.linalg.norm(np.column_stack([design, np.ones(len(y))]), 2) ** 2
    b_ahead = b
    for _ in range(250):
        off = 1 / (1 + np.exp(-(design @ ahead + b_ahead))) - y
        old, b_old = w, b
        w = ahead - pace * (design.T @ off) / len(y)
        w = np.sign(w) * np.maximum(np.abs(w) - pace * LASSO, 0)
        b = b_ahead - pace * off.mean()
        t, t_old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, b_ahead = w + (t_old - 1) / t * (w - old), b + (t_old - 1) / t * (b - b_old)
    kept = np.flatnonzero(w)
    return Ensemble([names[i] for i in kept], [float(w[i] / spread[i]) for i in kept], float(b))


def train(stats: DataFrame, labels: DataFrame, folds: bool = True) -> Ensemble:
    """Fits on at most ``TRAIN_ROWS`` labelled rows; with ``folds``, not on the held-out one."""
    known = labels.filter("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    if folds:
        known = known.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    joined = stats.join(known, "doc_id")
    rows = least_hashes(joined, joined.count(), TRAIN_ROWS).select(*STATS, "quality").collect()
    table = np.array(rows, np.float64).reshape(-1, len(STATS) + 1)
    return fit(table[:, :-1], table[:, -1])


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(spark, measure(read_documents(spark, sf_dir)), "rule-stats")
    score = train(stats, read_documents(spark, sf_dir, "labels")).score()
    return stats.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), score.alias("score")) \
        .withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted good, by rules learnt from them and all their labels."""
    ensemble = train(materialize(spark, measure(docs), "rule-stats"), labels, folds=False)
    kind = "struct<" + ",".join(f"{s}:double" for s in STATS) + ">"

    @F.pandas_udf(kind)
    def stats_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([quality_stats(t or "") for t in texts], columns=list(STATS))

    row, stat = F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.col("_stats")
    judged = docs.select(row.alias("_row"), stats_of("text").alias("_stats")).select("_row", *(stat[s].alias(s) for s in STATS))
    return judged.filter(ensemble.score() >= CUT).select("_row.*")
