"""Streams over several runs: replies that come late, early messages, counters; appends that are repeated; scorers that fail."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rewardlake.operators import plugins
from rewardlake.plans import catalog as C
from rewardlake.sources import batches, readers
from rewardlake.streaming import streams

T0 = datetime(2024, 1, 1)
SAMPLE = ("id string, sample_ord long, response string, prompt array<struct<role:string,content:string>>, "
          "reward_model struct<style:string,ground_truth:string>, ts timestamp")
REPLY = "sample_id string, judge_text string, ts timestamp"
BEST = '{"faithfulness": 5, "coverage": 5, "no_redundancy": 5, "appropriate_length": 5, "coherence": 5}'


def sample(name, minute, response="One. Two."):
    return (name, minute, response, [("user", "Article:\nx")], ("llmj", "r"), T0 + timedelta(minutes=minute))


def test_a_late_reply_scores_its_sample_once(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("samples", "replies", "out", "ckpt")}
    runs = [
        # a is answered at once, b one run later (twice), c and the blank d never, e beyond its wait
        ([sample("a", 0), sample("b", 1), sample("c", 2), sample("d", 3, " "), sample("e", 4)], [("a", BEST, T0)]),
        ([], [("b", BEST, T0 + timedelta(minutes=50)), ("b", BEST, T0 + timedelta(minutes=51))]),
        ([], [("b", None, T0 + timedelta(minutes=55)), ("nobody", BEST, T0 + timedelta(minutes=55))]),
        ([], [("e", BEST, T0 + timedelta(minutes=4, hours=3))]),
        ([sample(None, 2_000)], [(None, None, T0 + timedelta(minutes=2_000))]),
    ]
    out = []
    for samples, replies in runs:
        spark.createDataFrame(samples, SAMPLE).write.mode("append").parquet(paths["samples"])
        spark.createDataFrame(replies, REPLY).write.mode("append").parquet(paths["replies"])
        scores = streams.stream_judge_scores(*(spark.readStream.schema(spark.read.parquet(paths[n]).schema).parquet(paths[n])
                                               for n in ("samples", "replies")))
        streams.run_available_now(scores.select("id", "aggregate_reward_score", "pending"), paths["out"], paths["ckpt"])
        rows = spark.read.parquet(paths["out"]).filter("id is not null").collect() if os.path.exists(paths["out"]) else []
        out.append(sorted((r["id"], r["aggregate_reward_score"], r["pending"]) for r in rows))
    first = [("a", 1.0, False)]
    assert out[0] == first and out[1] == out[2] == [*first, ("b", 1.0, False)]
    assert out[-1] == [*first, ("b", 1.0, False), ("c", None, True), ("d", 0.0, False), ("e", None, True)]


TRAJ = ("episode_id string, turn int, role string, content string, "
        "tool_calls array<struct<name:string,arguments:string>>, ts timestamp")


def test_many_early_messages(spark, tmp_path):
    """20,000 messages ahead of their turn, some of them twice, then the first ones in two further runs."""
    n = 20_000
    early = spark.range(2, n).select(
        F.lit("e").alias("episode_id"), F.col("id").cast("int").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("content"),
        F.lit(None).cast("array<struct<name:string,arguments:string>>").alias("tool_calls"), F.lit(T0).alias("ts"))
    last = spark.createDataFrame([("e", n, "assistant", "<solution>S</solution>", None, T0)], TRAJ)
    src, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    deliveries = [early.unionByName(last), early.filter("turn % 100 = 0").withColumn("content", F.lit("again")),
                  spark.createDataFrame([("e", 1, "user", "x", None, T0)], TRAJ), spark.createDataFrame([("e", 0, "user", "q", None, T0)], TRAJ)]
    for k, part in enumerate(deliveries):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(TRAJ).parquet(src)
        streams.run_available_now(streams.assemble_episodes(streams.annotate_turns(stream)), sink, ckpt)
        rows = spark.read.schema(streams.EPISODE_OUT).parquet(sink).collect()
        assert len(rows) == (k == 3)
    assert rows[0]["ended_by"] == "solution" and rows[0]["final_sql"] == "S" and rows[0]["num_turns"] == 1


def test_counters_by_micro_batch(spark, tmp_path):
    rows = [(i, "kept" if i % 3 else "gone") for i in range(30)]
    df = spark.createDataFrame(rows, "i int, reason string")
    df.repartitionByRange(3, "i").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    observed, counters = streams.counted(stream, "test-counters", "reason", ["kept", "gone"])
    streams.run_available_now(observed, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert counters.totals() == {"rows": 30, "kept": 20, "gone": 10}
    assert len(counters.by_batch) == 3 and all(c["rows"] == c["kept"] + c["gone"] for c in counters.by_batch.values())
    spark.streams.removeListener(counters)


def test_a_batch_appended_twice_is_read_once(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = "i int, s string"
    assert batches.read_batches(spark, table, schema).count() == 0
    one, two = (spark.createDataFrame([(i, None)], schema) for i in (1, 2))
    assert batches.append_batch(one, table, "b1") and not batches.append_batch(one, table, "b1")
    assert batches.append_batch(two, table, "b2")
    # an attempt that died after its files, and one after its manifest entry was made
    two.write.json(f"{table}/{batches.ATTEMPTS}/dead")
    open(f"{table}/{batches.MANIFEST}/b3", "w").close()
    assert sorted(r["i"] for r in batches.read_batches(spark, table, schema).collect()) == [1, 2]
    assert batches.append_batch(spark.createDataFrame([(3, "x")], schema), table, "b3")
    assert sorted(r["i"] for r in batches.read_batches(spark, table, schema).collect()) == [1, 2, 3]


def test_scorers_that_raise_hang_or_die(spark):
    def score(rec):
        if rec["id"] == "raises":
            raise KeyError("no field")
        if rec["id"] == "hangs":
            while True:
                time.sleep(0.01)
        if rec["id"] == "spins":
            sum(range(10**12))  # in C, where no signal interrupts it
        if rec["id"] == "dies":
            os._exit(1)
        return 1.0, [("m", 2, "Metric")]

    ids = ["a", "raises", "b", "hangs", "spins", "c", "dies", "d"]
    samples = spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1)
    got = {r["id"]: r for r in plugins.partition_scorer(score, ["id"], seconds=0.5)(samples).collect()}
    assert {i: got[i]["aggregate_reward_score"] for i in ids} == {i: float(len(i) == 1) for i in ids}
    assert got["a"]["error"] is None and got["d"]["metrics_list"][0]["value"] == 2.0
    assert got["raises"]["error"] == "KeyError: 'no field'" and got["dies"]["error"] == "the scorer's process died"
    assert got["hangs"]["error"] == got["spins"]["error"] == "no score within 0.5 s"


@pytest.mark.parametrize("name", ["q_available_files", "q_schema_corpus"])
def test_files_of_every_key(spark, name):
    from conftest import SF_SMALL
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    want = labels.count() if name == "q_available_files" else labels.filter("quality = 1").count()
    assert C.REGISTRY[name](spark, SF_SMALL).count() == want


ODD_KEYS = ["a b", "a+b", "50%", "x/y=z", "é日", "", None, "_u", "c:d", "q'\"[^]", "twice", "twice"]


def test_files_by_key_as_spark_writes_and_reads_them(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(k, f"text of {k}\nline") for k in ODD_KEYS] + [("none", None)], "db_id string, value string")

    def round_trip(path):
        readers.write_by_key(rows, path, "db_id", shards=3)
        readers.write_by_key(rows, path, "db_id", shards=3)
        folders = readers.shard_folders(spark, path)
        tree = readers.read_text_tree(spark, folders, r"db_id=([^/]+)/[^/]+$")
        keys = readers.available_keys_from_files(spark, folders, ".txt", r"/db_id=([^/]+)/[^/]+$")
        return sorted((r["key"], r["text"]) for r in tree.collect()), sorted(r["db_id"] for r in keys.collect())

    own = round_trip(str(tmp_path / "own"))
    files = [f for _, _, names in os.walk(tmp_path / "own") for f in names]
    assert len(own[0]) == len(set(ODD_KEYS)) and files == ["part-0.txt"] * len(own[0])  # empty and null keys have one folder
    monkeypatch.setattr(readers, "local_path", lambda path: None)
    assert round_trip(str(tmp_path / "spark")) == own


def test_small_files_are_listed_by_tasks(spark, tmp_path):
    rows = spark.range(100).selectExpr("cast(id as string) db_id", "'x' value")
    readers.write_by_key(rows, f"file:{tmp_path}/t", "db_id")
    folders = readers.shard_folders(spark, f"file:{tmp_path}/t")
    for df in (readers.available_keys_from_files(spark, folders, ".txt", "db_id=([0-9]+)/"),
               readers.read_text_tree(spark, folders, "db_id=([0-9]+)/")):
        assert df.inputFiles() == [] and df.count() == 100


def test_questions_come_in_as_many_files_as_their_scan_has_splits(spark, monkeypatch):
    from conftest import SF_SMALL
    paths, fresh = {}, C.scratch_path
    monkeypatch.setattr(C, "scratch_path", lambda spark, name: paths.setdefault(name, fresh(spark, name)))
    few = {r["counter"]: r["n"] for r in C.q_stream_counts(spark, SF_SMALL).collect()}
    paths.clear()
    confs = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    before = {conf: spark.conf.get(conf) for conf in confs}
    for conf, value in confs.items():
        spark.conf.set(conf, value)
    try:
        many = {r["counter"]: r["n"] for r in C.q_stream_counts(spark, SF_SMALL).collect()}
    finally:
        for conf, value in before.items():
            spark.conf.set(conf, value)
    local = {n: p.removeprefix("file:") for n, p in paths.items()}
    files = [f for f in os.listdir(local["questions_in"]) if f.startswith("part-")]
    batches_run = [f for f in os.listdir(os.path.join(local["prompts_ckpt"], "commits")) if not f.startswith(".")]
    assert many == few and len(files) > 8 and len(batches_run) == 4
