"""Reward plug-in contract, artefact key listing, first-record preview, monitors."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rewardlake.operators import monitor, plugins
from rewardlake.plans import catalog as C
from rewardlake.sources import readers, standins as S


def test_presets_and_contract(spark):
    samples = S.code_samples(spark, SF_SMALL)
    presets = plugins.registry(outcomes=S.test_outcomes(spark, SF_SMALL), replies=S.judge_replies(spark, SF_SMALL))
    assert set(presets) == {"correctness", "correctness+conciseness", "judge5"}
    out = plugins.with_reward(samples, "correctness+conciseness", presets)
    assert out.columns == plugins.REWARD_SCHEMA.fieldNames() and out.count() == samples.count()
    corr = {r["id"]: r["aggregate_reward_score"] for r in plugins.with_reward(samples, "correctness", presets).collect()}
    assert all(0.0 <= v <= 1.0 for v in corr.values())
    with pytest.raises(ValueError):
        plugins.with_reward(samples, lambda df: df.select("id"))


def test_partition_scorer(spark):
    samples = S.judge_samples(spark, SF_SMALL)

    def score(rec):
        n = len(rec["response"].split())
        return min(n, 10) / 10, [("words", n, "Metric")]

    out = plugins.with_reward(samples, plugins.partition_scorer(score, ["id", "response"]))
    got = {r["id"]: r for r in out.collect()}
    ref = {r["id"]: len(r["response"].split()) for r in samples.collect()}
    assert {k: v["metrics_list"][0]["value"] for k, v in got.items()} == {k: float(v) for k, v in ref.items()}


def test_available_keys_from_files(spark):
    root = tempfile.mkdtemp(prefix="rewardlake-dbs-")
    for k in ["alpha", "beta", "gamma"]:
        os.makedirs(f"{root}/{k}")
        if k != "gamma":
            open(f"{root}/{k}/{k}.sqlite", "wb").write(b"x")
        open(f"{root}/{k}/other.sqlite", "wb").write(b"y")
    got = sorted(r["db_id"] for r in readers.available_keys_from_files(spark, root, ".sqlite").collect())
    assert got == ["alpha", "beta"]


def test_preview_first(spark):
    recs = C.convert.rlaif_convert(S.articles(spark, SF_SMALL))
    p = readers.preview_first(recs, "ordinal").first()["preview"]
    assert len(p) <= 2000 and p.startswith('{"ordinal":')


def test_verdict_rollup_and_window_lengths(spark):
    r = C._rewards(spark, SF_SMALL)
    flat = monitor.verdict_summary(r).agg(F.sum("episodes")).first()[0]
    roll = monitor.verdict_summary(r, with_subtotals=True)
    assert roll.filter(F.col("verdict").isNull()).first()["episodes"] == flat == r.count()
    ev = C._events_ts(spark, SF_SMALL).withColumn("len", F.lit(2.0))
    m = monitor.reward_monitor(ev, "ts", "value", "1 day", "12 hours", length_col="len")
    assert m.filter(F.col("mean_length") != 2.0).count() == 0 and m.count() > 0
