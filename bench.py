"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and forces full execution with the ``noop`` sink (no
rows are collected to the driver).  Each query runs ``$BENCH_REPEAT`` times
(default 2) and the best time is reported, so one-time JIT compilation of a
code path is not counted.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rewardlake.plans.catalog import REGISTRY  # noqa: E402
from rewardlake.session import clear_scratch, get_session  # noqa: E402

HEADLINE = [
    "q_rlaif_convert", "q_convert_stats", "q_first_n", "q_mtrl_convert", "q_rlvr_convert", "q_assert_literals",
    "q_rlvr_reward", "q_metrics_long", "q_judge_aggregate", "q_judge_request", "q_prompt_parse",
    "q_episode_rewards", "q_episode_metrics", "q_result_preview", "q_resultset_reward", "q_resultset_diff",
    "q_verdict_summary", "q_rollout_stats", "q_reward_monitor", "q_above_avg", "q_in_list", "q_top_n",
    "q_schema_default", "q_regex_all", "q_length_rule", "q_sentence_snap", "q_stream_monitor", "q_stream_episodes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    spark = get_session(f"local[{cpus}]", int(cpus))
    # warm-up (not timed): JVM start and the one-time start of the Python
    # workers (pandas/pyarrow imports) that Pandas UDFs reuse afterwards
    REGISTRY["q_count_filter"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, int(cpus) * 4, 1, int(cpus)).mapInPandas(lambda it: it, "id long") \
        .write.format("noop").mode("overwrite").save()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(repeat):
            t0 = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
            clear_scratch(spark)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "repeat": repeat}))


if __name__ == "__main__":
    main()
