"""Corpus pipeline over ``documents``: each stage's rows are written and reread as the next one's input.

Toxic documents go, then poor ones; of each group of near duplicates (five-word
shingles, similarity of 0.8 or more, taken transitively) the one with the least
id stays; secrets in the texts are masked; what is left is packed into
sequences.  The classifiers learn from all labelled rows of their stage's own
input.

Defined results: a null or empty text is kept by the first two stages if the
models say so, and is no near duplicate; of rows with the same id and texts in
one group, one stays; a null id counts as larger than any; an empty table
passes through as an empty one; columns that ``documents`` does not have are
kept by every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rewardlake.llm import jaccard, packing, rule_ensemble, secrets, toxicity
from rewardlake.llm.common import discard, read_documents
from rewardlake.session import materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(spark, docs, read_documents(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rule_ensemble.keep_good(spark, docs, read_documents(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(spark, docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", dedup_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the trained models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over ``documents``."""
    docs, written = read_documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        discard(*written)  # the stage before is done with
        written = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
