"""End-to-end use of the library on your own tables (here: the stand-ins).

    python examples/pipelines.py [sf_dir]

Converters write training files; scorers return reward records; episode
replay returns outcome rows.  Paths go to the shared checkpoint folder.
"""

import sys

sys.path.insert(0, __file__.rsplit("/examples/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from rewardlake.operators import code_reward, convert, episodes, judge_reward, resultset  # noqa: E402
from rewardlake.session import get_session, scratch_path  # noqa: E402
from rewardlake.sources import readers, standins as S  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = get_session("local[4]", 4)

# 1. convert: articles(ordinal, article, highlights) -> JSON Lines, first 5000 kept
articles = S.articles(spark, sf)
tagged, obs = readers.observe_counts(convert.rlaif_tagged(articles), "rlaif", "reason", ["converted", "skipped_short"])
out = scratch_path(spark, "rlaif_train")
readers.write_jsonl(convert.first_n(tagged.filter(F.col("reason") == "converted"), "ordinal", convert.RLAIF_MAX_SAMPLES)
                    .select("data_source", "prompt", "ability", "reward_model"), out)
print("summaries:", obs.get, readers.warn_if_empty(obs))

# 2. convert: coding problems(problem_id, prompt, test_list) -> JSON Lines
readers.write_jsonl(convert.rlvr_convert(S.code_problems(spark, sf)).select("data_source", "prompt", "ability", "reward_model"),
                    scratch_path(spark, "code_train"))

# 3. convert: questions + bundled dbs + schema dumps -> one-column prompt parquet
corpus = readers.schema_corpus(S.schema_files(spark, sf))
prompts = convert.mtrl_convert(S.questions(spark, sf), S.available_dbs(spark, sf), corpus, convert.MTRL_MAX_SAMPLES)
readers.write_prompt_parquet(prompts, scratch_path(spark, "sql_prompts"))

# 4. score: code samples + test outcomes -> reward records
code_reward.rlvr_rewards(S.code_samples(spark, sf), S.test_outcomes(spark, sf)).show(3, truncate=60)

# 5. score: summaries -> judge requests; judge replies -> reward records
judge_reward.judge_requests(S.judge_samples(spark, sf)).show(2, truncate=60)
judge_reward.judge_rewards(S.judge_samples(spark, sf), S.judge_replies(spark, sf)).show(3, truncate=60)

# 6. episodes: trajectories + episode table + result-set equality -> outcomes
eq = resultset.result_set_rewards(S.customer_episodes(spark, sf), S.result_rows(spark, sf))
episodes.episode_rewards(S.trajectories(spark, sf), S.episodes_meta(spark, sf), eq) \
    .select("episode_id", "reward", "verdict", "outcome").show(3, truncate=80)
