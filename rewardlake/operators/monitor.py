"""Monitoring tables over rewards (AGG8-AGG10, batch side of STR3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Means of fixed-point values (rewards have <= 4 decimals, event values 2) are
# computed from DECIMAL sums: exact, so independent of partitioning and of the
# order rows are summed in -- a rerun after a lost executor gives the same bits.
REWARD_SCALE = 4


def exact_sum(c, scale: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(f"decimal(38,{scale})"))


def exact_mean(c, scale: int) -> Column:
    """Mean of a column whose values have at most ``scale`` decimals."""
    c = F.col(c) if isinstance(c, str) else c
    return exact_sum(c, scale).cast("double") / F.count(c)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_to_instant(c) -> Column:
    """TIMESTAMP_NTZ wall clock read as UTC -> TIMESTAMP, without the session
    time zone (watermarks need TIMESTAMP; a plain cast would use the zone)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), c))


def instant_to_utc_text(c) -> Column:
    """TIMESTAMP -> its UTC wall clock as text, independent of the session zone."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(_EPOCH_NTZ).cast("timestamp_ntz")).cast("string")


def verdict_summary(rewards: DataFrame, with_subtotals: bool = False) -> DataFrame:
    """AGG8: episodes and mean reward per (verdict, db_id); ``rollup`` adds
    per-verdict and grand totals."""
    g = rewards.rollup("verdict", "db_id") if with_subtotals else rewards.groupBy("verdict", "db_id")
    return g.agg(F.count(F.lit(1)).alias("episodes"), exact_mean("reward", REWARD_SCALE).alias("mean_reward"))


def rollout_stats(scored: DataFrame, group_col: str, score_col: str, item_col: str,
                  scale: int = REWARD_SCALE) -> DataFrame:
    """AGG10: per prompt group -- count, mean, population stddev and max of the
    scores, and the best-scored item (``max_by``); all partial aggregates."""
    return scored.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n"), exact_mean(score_col, scale).alias("mean_score"),
        F.stddev_pop(score_col).alias("std_score"), F.max(score_col).alias("max_score"),
        F.max_by(item_col, F.struct(F.col(score_col), F.col(item_col))).alias("best_item"))


def reward_monitor(df: DataFrame, ts_col: str, value_col: str, every: str = "1 day",
                   slide: str | None = None, length_col: str | None = None, scale: int = REWARD_SCALE) -> DataFrame:
    """AGG9: mean reward (and mean episode length) per tumbling or sliding window."""
    w = F.window(ts_col, every, slide) if slide else F.window(ts_col, every)
    aggs = [F.count(F.lit(1)).alias("n"), exact_mean(value_col, scale).alias("mean_reward")]
    if length_col:
        aggs.append(F.avg(length_col).alias("mean_length"))
    return df.groupBy(w.alias("w")).agg(*aggs).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mean_reward",
        *(["mean_length"] if length_col else []))
