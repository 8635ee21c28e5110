"""Reward-function contract and plug-ins (UDF1-UDF3).

A reward is a function ``DataFrame -> DataFrame`` returning one row per
sample with ``id``, ``aggregate_reward_score`` and ``metrics_list``.  Presets
are expression-only; user code that cannot be an expression runs per
partition through ``mapInPandas`` (Arrow batches, resources opened once per
partition), in a child process with a time limit for each sample.
"""

from __future__ import annotations

import multiprocessing
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .code_reward import rlvr_rewards
from .judge_reward import judge_rewards

REWARD_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("aggregate_reward_score", T.DoubleType()),
    T.StructField("metrics_list", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("value", T.DoubleType()),
        T.StructField("type", T.StringType())]))),
])

Reward = Callable[[DataFrame], DataFrame]


def _correctness_only(outcomes: DataFrame) -> Reward:
    def run(samples: DataFrame) -> DataFrame:
        r = rlvr_rewards(samples, outcomes)
        score = F.when(F.col("total") > 0, F.bround(F.col("passed") / F.col("total"), 4)).otherwise(F.lit(0.0))
        return r.select("id", score.alias("aggregate_reward_score"),
                        F.array(F.struct(F.lit("correctness").alias("name"), score.alias("value"),
                                         F.lit("Reward").alias("type"))).alias("metrics_list"))
    return run


def registry(outcomes: DataFrame | None = None, replies: DataFrame | None = None) -> dict[str, Reward]:
    """UDF2: preset rewards by name (the flag that picks preset vs custom)."""
    out: dict[str, Reward] = {}
    if outcomes is not None:
        out["correctness"] = _correctness_only(outcomes)
        out["correctness+conciseness"] = lambda s: rlvr_rewards(s, outcomes).select(*REWARD_SCHEMA.fieldNames())
    if replies is not None:
        out["judge5"] = lambda s: judge_rewards(s, replies).select(*REWARD_SCHEMA.fieldNames())
    return out


def with_reward(samples: DataFrame, reward: Reward | str, presets: dict[str, Reward] | None = None) -> DataFrame:
    """UDF1: apply a reward (callable or preset name) and check the contract."""
    fn = (presets or {})[reward] if isinstance(reward, str) else reward
    out = fn(samples)
    missing = [c for c in REWARD_SCHEMA.fieldNames() if c not in out.columns]
    if missing:
        raise ValueError(f"reward output lacks columns {missing}")
    return out


#: Seconds that a scorer may take for a sample (fixed value of the reference).
SCORE_SECONDS = 5.0

Scored = tuple[float, list[tuple[str, float, str]]]


class IsolatedScorer:
    """Runs a scorer in a child process, sample by sample, under a time limit.

    A sample that raises gives score 0 and the reason.  One that takes too long,
    or takes the child down with it, does so too; then the child is ended and
    the next sample gets a new one.
    """

    def __init__(self, score_row: Callable[[dict], Scored], seconds: float = SCORE_SECONDS) -> None:
        self.score_row, self.seconds, self.child, self.pipe = score_row, seconds, None, None

    def _serve(self, pipe) -> None:
        while True:
            try:
                sample = pipe.recv()
            except EOFError:
                os._exit(0)
            try:
                score, metrics = self.score_row(sample)
                pipe.send((float(score), [(str(n), float(v), str(t)) for n, v, t in metrics], None))
            except BaseException as error:  # noqa: BLE001 - whatever a user's scorer may raise
                pipe.send((0.0, [], f"{type(error).__name__}: {error}"))

    def score(self, sample: dict) -> tuple[float, list[tuple[str, float, str]], str | None]:
        if self.child is None:
            context = multiprocessing.get_context("fork")
            self.pipe, theirs = context.Pipe()
            self.child = context.Process(target=self._serve, args=(theirs,), daemon=True)
            self.child.start()
            theirs.close()
        try:
            self.pipe.send(sample)
            if self.pipe.poll(self.seconds):
                return self.pipe.recv()
            reason = f"no score within {self.seconds:g} s"
        except (EOFError, OSError):
            reason = "the scorer's process died"
        self.close()
        return 0.0, [], reason

    def close(self) -> None:
        if self.child is not None:
            self.child.kill()
            self.child.join()
            self.pipe.close()
            self.child = None


def partition_scorer(score_row: Callable[[dict], Scored], columns: list[str], seconds: float = SCORE_SECONDS) -> Reward:
    """UDF3: wrap a per-sample Python scorer as a ``mapInPandas`` reward.

    ``score_row(sample_dict) -> (score, [(name, value, type), ...])``.  ``error``
    says why a sample got no score of its own (see ``IsolatedScorer``).
    """
    def run(samples: DataFrame) -> DataFrame:
        def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer = IsolatedScorer(score_row, seconds)
            try:
                for pdf in it:
                    records = pdf.to_dict("records")
                    scores, metrics, errors = zip(*map(scorer.score, records)) if records else ((), (), ())
                    yield pd.DataFrame({
                        "id": [r.get("id") for r in records], "aggregate_reward_score": scores, "error": errors,
                        "metrics_list": [[{"name": n, "value": v, "type": t} for n, v, t in m] for m in metrics]})
            finally:
                scorer.close()
        schema = T.StructType([*REWARD_SCHEMA.fields, T.StructField("error", T.StringType())])
        return samples.select(*columns).mapInPandas(batches, schema)
    return run
