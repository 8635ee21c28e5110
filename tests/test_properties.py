"""Property tests: result-set equality equals Python's set(tuple) semantics;
episode state survives messages split across micro-batches."""

import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rewardlake.operators import episodes as E
from rewardlake.operators import resultset as R
from rewardlake.streaming import streams
from test_resultset import cells_df

value = st.one_of(st.none(), st.integers(-3, 3), st.sampled_from([0.5, -0.0, 1.0, 2.0]), st.booleans(),
                  st.sampled_from(["1", "a", ""]))
rows = st.lists(st.tuples(value, value), max_size=6)


def py_key(v):
    # Python's set treats 1 == 1.0 == True and -0.0 == 0; text stays text
    return v


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pred=rows, gold=rows)
def test_equality_matches_python_sets(spark, pred, gold):
    res = cells_df(spark, {("e", "pred"): pred, ("e", "gold"): gold})
    eps = spark.createDataFrame([("e",)], "episode_id string")
    got = R.result_set_rewards(eps, res).first()["sets_equal"]
    assert got == (set(pred) == set(gold))


TRAJ = ("episode_id string, turn int, role string, content string, "
        "tool_calls array<struct<name:string,arguments:string>>, ts timestamp")


def test_stream_state_across_batches(spark):
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1)
    obs = "<observation>\nResult (1 rows):\n  (1,)\n</observation>"
    msgs = {
        "a": [("user", "q"), ("assistant", "<sql>S1</sql>"), ("user", obs), ("assistant", "<solution>S2</solution>")],
        "b": [("user", "q")] + [m for i in range(6) for m in (("assistant", f"<sql>Q{i}</sql>"), ("user", obs))],
        "c": [("user", "q"), ("assistant", "thinking")],
    }
    rows = [(ep, t, r, c, None, t0 + timedelta(minutes=t)) for ep, ms in msgs.items() for t, (r, c) in enumerate(ms)]
    df = spark.createDataFrame(rows, TRAJ)
    src = tempfile.mkdtemp(prefix="rewardlake-stream-src-")
    # two deliveries: early turns first, the rest in a later file
    df.filter(F.col("turn") < 2).coalesce(1).write.mode("append").parquet(src)
    df.filter(F.col("turn") >= 2).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    sink, ck = tempfile.mkdtemp(prefix="rewardlake-sink-"), tempfile.mkdtemp(prefix="rewardlake-ck-")
    os.rmdir(sink)
    streams.run_available_now(streams.assemble_episodes(streams.annotate_turns(stream)), sink, ck)
    got = {r["episode_id"]: r for r in spark.read.parquet(sink).collect()}
    batch = {r["episode_id"]: r for r in E.episode_metrics(df).collect()}
    for ep in ("a", "b"):
        for c in ("num_turns", "sql_attempts", "sql_errors", "empty_responses", "submitted_solution"):
            assert got[ep][c] == batch[ep][c], (ep, c)
    assert got["a"]["ended_by"] == "solution" and got["b"]["ended_by"] == "turn_cap"
