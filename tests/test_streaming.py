"""Streaming equals batch."""

from conftest import SF_SMALL

from rewardlake.plans import catalog as C


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stream_monitor_equals_batch(spark):
    cols = ["window_start", "n", "mean_reward"]
    assert rows(C.q_stream_monitor(spark, SF_SMALL), cols) == rows(C.q_reward_monitor(spark, SF_SMALL), cols)


def test_stream_episodes_equal_batch_metrics(spark):
    cols = ["episode_id", "num_turns", "sql_attempts", "sql_errors", "empty_responses", "submitted_solution"]
    batch = C.q_episode_metrics(spark, SF_SMALL)
    stream = C.q_stream_episodes(spark, SF_SMALL)
    assert rows(stream, cols) == rows(batch, cols)


def test_stream_dedup_and_score(spark):
    once = C.q_score_batch(spark, SF_SMALL)
    assert C.q_stream_dedup(spark, SF_SMALL).count() == once.count()
    a = rows(C.q_stream_score(spark, SF_SMALL), ["id", "aggregate_reward_score"])
    assert a == rows(once, ["id", "aggregate_reward_score"])
