"""Registered queries: one builder ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Outputs are flat (strings, numbers, booleans) so
they can be compared with the SQL oracle; the library functions themselves
return the nested reference records.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonfns import tool_args_sql
from ..functions.text import (create_statements, extract_code, extract_solution, extract_sql, length_rule,
                              nonblank_lines, conciseness, observation_body, py_strip, sentence_snap,
                              summary_sentences)
from ..operators import code_reward, convert, episodes, judge_reward, monitor, plugins, resultset
from ..sources import arrays, batches, readers, standins as S
from ..session import materialize, scratch_path
from ..streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _flat_record(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "data_source", F.col("prompt")[0]["role"].alias("role"),
                     F.col("prompt")[0]["content"].alias("content"), "ability",
                     F.col("reward_model.style").alias("style"), F.col("reward_model.ground_truth").alias("ground_truth"))


# ---------------------------------------------------------------- converters
@query
def q_rlaif_convert(spark, sf_dir):
    return _flat_record(convert.rlaif_convert(S.articles(spark, sf_dir)), "ordinal")


@query
def q_min_length(spark, sf_dir):
    t = S.articles(spark, sf_dir)
    a, h = py_strip("article"), py_strip("highlights")
    return t.filter((F.length(a) >= convert.MIN_ARTICLE_CHARS) & (F.length(h) >= convert.MIN_HIGHLIGHT_CHARS)) \
            .select("ordinal", F.length(a).alias("article_chars"), F.length(h).alias("highlight_chars"))


@query
def q_sentence_snap(spark, sf_dir):
    t = S.articles(spark, sf_dir)
    a = py_strip("article")
    snap = sentence_snap(a)
    return t.select("ordinal", F.length(a).alias("article_chars"), F.length(snap).alias("snapped_chars"),
                    snap.alias("article"))


@query
def q_first_n(spark, sf_dir):
    kept = convert.rlaif_convert(S.articles(spark, sf_dir), max_samples=convert.RLAIF_MAX_SAMPLES)
    return kept.select("ordinal", F.col("reward_model.ground_truth").alias("ground_truth"))


@query
def q_convert_stats(spark, sf_dir):
    tagged = convert.rlaif_tagged(S.articles(spark, sf_dir))
    return convert.capped_stats(tagged, "ordinal", convert.RLAIF_MAX_SAMPLES)


#: Cap of the two-split queries: low enough to bind on the smallest tables.
SPLIT_CAP = 60


def _split_articles(spark, sf_dir):
    """LIM1 over (split, ordinal): documents in English are the first split, all others the second."""
    d = readers.read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    t = d.select(F.col("doc_id").alias("ordinal"), F.col("text").alias("article"), F.col("text").alias("highlights"), "lang")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    return readers.union_splits({"train": t.filter(english), "test": t.filter(~english)})


@query
def q_first_n_splits(spark, sf_dir):
    """SRC1 + LIM1: the first rows over both splits, in the order split, ordinal; more than the first split has."""
    t = _split_articles(spark, sf_dir)
    n = t.filter(F.col("split") == "train").count() + SPLIT_CAP
    kept = convert.rlaif_convert(t, max_samples=n)
    return kept.select("split_ord", "ordinal", F.col("reward_model.ground_truth").alias("ground_truth"))


@query
def q_convert_stats_splits(spark, sf_dir):
    """AGG7 under LIM1 over both splits, the cap being reached within the first."""
    tagged = convert.rlaif_tagged(_split_articles(spark, sf_dir))
    return convert.capped_stats(tagged, ["split_ord", "ordinal"], SPLIT_CAP)


@query
def q_mtrl_stats(spark, sf_dir):
    """AGG7: the text-to-SQL converter's three counters under its own cap."""
    tagged = convert.mtrl_tagged(_questions(spark, sf_dir), S.available_dbs(spark, sf_dir), _corpus(spark, sf_dir))
    return convert.capped_stats(tagged.select("ordinal", "reason"), "ordinal", convert.MTRL_MAX_SAMPLES)


@query
def q_observed_counts(spark, sf_dir):
    """SNK3: the counters gathered while the rows are written, as rows."""
    reasons = ["converted", "skipped_empty", "skipped_missing_db"]
    tagged = convert.mtrl_tagged(_questions(spark, sf_dir), S.available_dbs(spark, sf_dir), _corpus(spark, sf_dir))
    counted, obs = readers.observe_counts(tagged, "mtrl", "reason", reasons)
    readers.write_prompt_parquet(counted.filter("reason = 'converted'"), scratch_path(spark, "counted"))
    got = obs.get
    return spark.createDataFrame([(c, int(got[c] or 0)) for c in [*reasons, "rows"]], "counter string, n long")


@query
def q_available_files(spark, sf_dir):
    """SRC5 on real files: an artefact for every labelled document's key (keys with a blank), written by the executors
    into sharded folders and listed without reading any content."""
    path = scratch_path(spark, "artefacts")
    keys = readers.read_table(spark, sf_dir, "labels", ["doc_id"]).distinct().select(
        F.concat(F.col("doc_id").cast("string"), F.lit(" db")).alias("db_id"), F.lit("artefact").alias("value"))
    readers.write_by_key(keys, path, "db_id")
    folders = readers.shard_folders(spark, path)
    if not folders:
        return spark.createDataFrame([], "db_id string")
    return readers.available_keys_from_files(spark, folders, ".txt", r"/db_id=([^/]+)/[^/]+$")


@query
def q_length_rule(spark, sf_dir):
    d = readers.read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", length_rule(py_strip("text")).alias("length_rule"))


@query
def q_summary_sentences(spark, sf_dir):
    d = readers.read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", summary_sentences(py_strip("text")).alias("summary_sentences"))


@query
def q_union_splits(spark, sf_dir):
    d = readers.read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    train = d.filter(F.col("lang") == "en")
    test = d.filter(~(F.col("lang") == "en") | F.col("lang").isNull())
    u = readers.union_splits({"train": train, "test": test})
    return u.select("split", F.col("doc_id").alias("ordinal"), F.col("text").alias("article"))


def _questions(spark, sf_dir):
    return S.questions(spark, sf_dir)


def _non_blank(q):
    from ..functions.text import is_blank
    return q.filter(~is_blank("question") & ~is_blank("query"))


@query
def q_blank_filter(spark, sf_dir):
    return _non_blank(_questions(spark, sf_dir)).select("ordinal", "db_id")


@query
def q_semi_available(spark, sf_dir):
    q = _non_blank(_questions(spark, sf_dir))
    return convert.semi_available(q, S.available_dbs(spark, sf_dir)).select("ordinal", "db_id")


@query
def q_anti_missing(spark, sf_dir):
    q = _non_blank(_questions(spark, sf_dir))
    return convert.anti_missing(q, S.available_dbs(spark, sf_dir)).select("ordinal", "db_id")


def _corpus(spark, sf_dir):
    return readers.schema_corpus(S.schema_files(spark, sf_dir))


@query
def q_schema_default(spark, sf_dir):
    q = _questions(spark, sf_dir).select("ordinal", "db_id")
    return convert.with_schema(q, _corpus(spark, sf_dir)).select("ordinal", "db_id", "schema")


@query
def q_mtrl_convert(spark, sf_dir):
    m = convert.mtrl_convert(_questions(spark, sf_dir), S.available_dbs(spark, sf_dir), _corpus(spark, sf_dir))
    rec = F.from_json("prompt", "prompt array<struct<role:string,content:string>>, env_class string, "
                                "reward_spec struct<ground_truth:string,style:string>, "
                                "extra_info struct<db_id:string,question:string,split:string>")
    return m.select("ordinal", "db_id", rec.alias("r")).select(
        "ordinal", "db_id", F.col("r.prompt")[0]["content"].alias("system_content"),
        F.col("r.prompt")[1]["content"].alias("user_content"), F.col("r.env_class").alias("env_class"),
        F.col("r.reward_spec.ground_truth").alias("ground_truth"), F.col("r.extra_info.split").alias("split"))


@query
def q_regex_all(spark, sf_dir):
    f = S.schema_files(spark, sf_dir)
    found = F.regexp_extract_all("schema_sql", F.lit(r"(?si)CREATE TABLE.*?\(.*?\);"), F.lit(0))
    return f.select("db_id", F.size(found).alias("n_creates"), create_statements("schema_sql").alias("ddl"))


@query
def q_schema_corpus(spark, sf_dir):
    """SRC4 + FN15 + FLT11 over real files: the derived dumps are written as
    one file per database folder (names with a blank), then read back whole
    and keyed by folder."""
    path = scratch_path(spark, "schema_files")
    dumps = S.schema_files(spark, sf_dir).withColumn("db_id", F.replace("db_id", F.lit("_"), F.lit(" ")))
    readers.write_by_key(dumps, path, "db_id")
    folders = readers.shard_folders(spark, path)
    if not folders:
        return spark.createDataFrame([], "db_id string, ddl string")
    files = readers.read_text_tree(spark, folders, r"db_id=([^/]+)/[^/]+$")
    corpus = readers.schema_corpus(files, key_col="key", text_col="text")
    return corpus.withColumn("db_id", F.replace("db_id", F.lit(" "), F.lit("_")))


@query
def q_available_keys(spark, sf_dir):
    return S.available_dbs(spark, sf_dir).distinct()


# ---------------------------------------------------------------- code reward
@query
def q_extract_code(spark, sf_dir):
    s = S.code_samples(spark, sf_dir)
    return s.select("id", extract_code("response").alias("code"))


@query
def q_conciseness(spark, sf_dir):
    s = S.code_samples(spark, sf_dir).select("id", extract_code("response").alias("code"))
    n = nonblank_lines("code")
    return s.select("id", n.alias("code_lines"), conciseness(n).alias("conciseness"))


@query
def q_rlvr_reward(spark, sf_dir):
    r = code_reward.rlvr_rewards(S.code_samples(spark, sf_dir), S.test_outcomes(spark, sf_dir))
    return r.select("id", "aggregate_reward_score", "total", "passed", "correctness", "conciseness", "code_lines")


@query
def q_rlvr_correctness(spark, sf_dir):
    r = code_reward.rlvr_rewards(S.code_samples(spark, sf_dir), S.test_outcomes(spark, sf_dir))
    return r.select(F.col("id").alias("sample_id"), "total", "passed",
                    F.when(F.col("total") > 0, F.col("passed") / F.col("total")).otherwise(F.lit(0.0)).alias("correctness"))


@query
def q_ground_truth_fallback(spark, sf_dir):
    g = code_reward.ground_truth_text(S.code_samples(spark, sf_dir))
    return g.select("id", "gt_source", "gt")


@query
def q_zip_tests(spark, sf_dir):
    z = code_reward.zip_tests(S.code_samples(spark, sf_dir))
    return z.select("sample_id", "test_idx", "assertion", "fn_name",
                    F.array_join("args", "\n").alias("args_text"), "expected")


@query
def q_test_outcomes(spark, sf_dir):
    tests = code_reward.zip_tests(S.code_samples(spark, sf_dir)).select("sample_id", "test_idx")
    out = S.test_outcomes(spark, sf_dir).groupBy("sample_id", "test_idx").agg(F.bool_or("passed").alias("passed"))
    j = tests.join(out, ["sample_id", "test_idx"], "left")
    return j.select("sample_id", "test_idx", F.coalesce("passed", F.lit(False)).alias("passed"))


@query
def q_fn_name(spark, sf_dir):
    p = S.code_problems(spark, sf_dir)
    from ..functions.text import fn_name_from_tests
    return p.select("problem_id", fn_name_from_tests("test_list").alias("fn_name"))


@query
def q_assert_table(spark, sf_dir):
    return convert.assertion_table(S.code_problems(spark, sf_dir))


@query
def q_assert_literals(spark, sf_dir):
    t = convert.rlvr_tagged(S.code_problems(spark, sf_dir))
    z = t.select("problem_id", F.posexplode(F.arrays_zip("inputs", "outputs")).alias("test_idx", "io"))
    return z.select("problem_id", "test_idx", F.col("io.inputs").alias("input"), F.col("io.outputs").alias("output"))


@query
def q_rlvr_convert(spark, sf_dir):
    c = convert.rlvr_convert(S.code_problems(spark, sf_dir))
    return c.select("problem_id", "fn_name", F.size("inputs").alias("n_tests"),
                    F.col("prompt")[0]["content"].alias("content"),
                    F.col("reward_model.ground_truth").alias("ground_truth"))


@query
def q_double_json(spark, sf_dir):
    """FN24: ground truth JSON inside the JSON record, decoded twice."""
    c = convert.rlvr_convert(S.code_problems(spark, sf_dir))
    line = F.to_json(F.struct("data_source", "prompt", "ability", "reward_model"))
    back = F.from_json(line, convert.TRAINING_RECORD)
    gt = F.from_json(back["reward_model"]["ground_truth"], "fn_name string, inputs array<string>, outputs array<string>")
    return c.select("problem_id", gt.alias("gt")).select(
        "problem_id", F.col("gt.fn_name").alias("fn_name"), F.size("gt.inputs").alias("n_inputs"),
        F.col("gt.inputs")[0].alias("first_input"), F.col("gt.outputs")[0].alias("first_output"))


# ---------------------------------------------------------------- judge reward
@query
def q_judge_parse(spark, sf_dir):
    r = S.judge_replies(spark, sf_dir)
    s = judge_reward.parse_judge(F.col("judge_text"))
    return r.select("sample_id", *[s[d].alias(d) for d in judge_reward.DIMENSIONS])


@query
def q_judge_aggregate(spark, sf_dir):
    r = judge_reward.judge_rewards(S.judge_samples(spark, sf_dir), S.judge_replies(spark, sf_dir))
    return r.select("id", "aggregate_reward_score", *judge_reward.DIMENSIONS, "summary_sentences", "length_rule",
                    "out_of_range")


@query
def q_metrics_long(spark, sf_dir):
    a = code_reward.rlvr_rewards(S.code_samples(spark, sf_dir), S.test_outcomes(spark, sf_dir))
    b = judge_reward.judge_rewards(S.judge_samples(spark, sf_dir), S.judge_replies(spark, sf_dir))
    la = code_reward.metrics_long(a).withColumn("scorer", F.lit("rlvr"))
    lb = code_reward.metrics_long(b).withColumn("scorer", F.lit("rlaif"))
    return la.unionByName(lb).select("scorer", "id", "metric_idx", "name", "value", "type")


@query
def q_judge_request(spark, sf_dir):
    return judge_reward.judge_requests(S.judge_samples(spark, sf_dir)).select("id", "request")


@query
def q_article_from_prompt(spark, sf_dir):
    from ..functions.text import article_from_prompt
    s = S.judge_samples(spark, sf_dir)
    return s.select("id", article_from_prompt("prompt").alias("article"))


@query
def q_prompt_parse(spark, sf_dir):
    """SRC6: prompt cells written as JSON (plain text for every 10th key) and
    read back with the wrap-as-user-message fallback."""
    d = readers.read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    rec = F.struct(
        F.array(F.struct(F.lit("system").alias("role"), F.lit(convert.SQL_SYSTEM_PROMPT).alias("content")),
                F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("prompt"),
        F.lit("text2sql").alias("env_class"),
        F.struct(F.concat(F.lit("SELECT "), F.col("doc_id").cast("string")).alias("ground_truth"),
                 F.lit("rule").alias("style")).alias("reward_spec"),
        F.struct(F.concat(F.lit("db_"), F.col("doc_id").cast("string")).alias("db_id"),
                 F.col("text").alias("question"), F.lit("train").alias("split")).alias("extra_info"))
    raw = d.select("doc_id", F.when(F.col("doc_id") % 10 == 0, F.col("text")).otherwise(F.to_json(rec)).alias("prompt"))
    p = readers.read_prompt_records(raw)
    users = F.filter("record.prompt", lambda m: m["role"] == "user")
    return p.select("doc_id", F.size("record.prompt").alias("n_messages"),
                    F.try_element_at(users, F.lit(1))["content"].alias("user_content"),
                    F.coalesce(F.col("record.reward_spec.ground_truth"), F.lit("")).alias("gold_query"),
                    F.coalesce(F.col("record.extra_info.db_id"), F.lit("")).alias("db_id"))


# ---------------------------------------------------------------- episodes
def _traj(spark, sf_dir):
    return materialize(spark, S.trajectories(spark, sf_dir), "trajectories")


def _rewards(spark, sf_dir, allow_fallback=False):
    eq = resultset.result_set_rewards(S.customer_episodes(spark, sf_dir), S.result_rows(spark, sf_dir))
    return episodes.episode_rewards(_traj(spark, sf_dir), S.episodes_meta(spark, sf_dir), eq, allow_fallback)


@query
def q_extract_sql(spark, sf_dir):
    t = _traj(spark, sf_dir).filter(F.col("role") == "assistant")
    return t.select("episode_id", "turn", extract_sql("content").alias("sql"))


@query
def q_extract_solution(spark, sf_dir):
    t = _traj(spark, sf_dir).filter(F.col("role") == "assistant")
    return t.select("episode_id", "turn", extract_solution("content").alias("solution"))


@query
def q_observation_body(spark, sf_dir):
    t = _traj(spark, sf_dir).filter(F.col("role") == "user")
    b = observation_body("content")
    return t.filter(b.isNotNull()).select("episode_id", "turn", b.alias("body"),
                                          b.startswith(episodes.ERROR_PREFIX).alias("is_error"))


@query
def q_tool_call_sql(spark, sf_dir):
    m = S.tool_call_messages(spark, sf_dir)
    return m.select("call_id", tool_args_sql("arguments").alias("sql"))


@query
def q_action_kind(spark, sf_dir):
    a = episodes.assistant_actions(_traj(spark, sf_dir))
    return a.select("episode_id", "turn", "action", "sql", "recorded_content")


@query
def q_action_observation(spark, sf_dir):
    k = episodes.kept_turns(_traj(spark, sf_dir)).filter(F.col("sql").isNotNull())
    return k.select("episode_id", "turn", "sql", "observation", "errored")


@query
def q_episode_truncate(spark, sf_dir):
    k = episodes.kept_turns(_traj(spark, sf_dir))
    return k.select("episode_id", "turn", "a_idx", "turns_left", "action")


@query
def q_episode_metrics(spark, sf_dir):
    return episodes.episode_metrics(_traj(spark, sf_dir)).select(
        "episode_id", "num_turns", "sql_attempts", "sql_errors", "empty_responses", "submitted_solution",
        "last_successful_sql", "last_observation")


@query
def q_last_success(spark, sf_dir):
    """WIN3: running last successful SQL per kept turn (a window over at
    most MAX_TURNS rows per episode)."""
    k = episodes.kept_turns(_traj(spark, sf_dir))
    w = Window.partitionBy("episode_id").orderBy("a_idx").rowsBetween(Window.unboundedPreceding, 0)
    run = F.last(F.when(F.col("succeeded"), F.col("sql")), ignorenulls=True).over(w)
    return k.select("episode_id", "turn", run.alias("last_successful_sql"))


@query
def q_observation_text(spark, sf_dir):
    return episodes.observation_texts(_traj(spark, sf_dir)).select("episode_id", "turn", "turns_left", "message")


@query
def q_episode_rewards(spark, sf_dir):
    return _rewards(spark, sf_dir).select("episode_id", "db_id", "reward", "status", "verdict", "reason", "final_sql",
                                          "num_turns", "sql_attempts", "sql_errors", "empty_responses",
                                          "submitted_solution", "used_last_sql_fallback")


@query
def q_fallback_reward(spark, sf_dir):
    return _rewards(spark, sf_dir, allow_fallback=True).select(
        "episode_id", "reward", "verdict", "final_sql", "used_last_sql_fallback")


@query
def q_episode_outcome(spark, sf_dir):
    return _rewards(spark, sf_dir).select("episode_id", "outcome")


@query
def q_episode_flat(spark, sf_dir):
    return episodes.flat_attributes(_rewards(spark, sf_dir), prefix="episode_")


@query
def q_verdict_summary(spark, sf_dir):
    v = monitor.verdict_summary(_rewards(spark, sf_dir))
    return v.select("verdict", "db_id", "episodes", "mean_reward")


# ---------------------------------------------------------------- result sets
@query
def q_resultset_reward(spark, sf_dir):
    return resultset.result_set_rewards(S.customer_episodes(spark, sf_dir), S.result_rows(spark, sf_dir))


@query
def q_resultset_diff(spark, sf_dir):
    d = resultset.result_set_diff(S.result_rows(spark, sf_dir))
    number = lambda i: resultset.number_text(F.col("cells")[i])
    return d.select("episode_id", "only_in", F.col("cells")[0]["s"].alias("status"), F.col("cells")[1]["i"].alias("yr"),
                    number(2).alias("price"), number(3).alias("ratio"), number(4).alias("size"))


@query
def q_result_preview(spark, sf_dir):
    return resultset.result_preview(S.result_rows(spark, sf_dir), episodes=S.customer_episodes(spark, sf_dir),
                                    texts=S.result_texts())


# ---------------------------------------------------------------- monitors
@query
def q_rollout_stats(spark, sf_dir):
    e = readers.read_table(spark, sf_dir, "events", ["event_id", "user_id", "value"])
    r = monitor.rollout_stats(e, "user_id", "value", "event_id")
    return r.select("user_id", "n", "mean_score", "std_score", "max_score", F.col("best_item").alias("best_event_id"))


def _events_ts(spark, sf_dir):
    """Events with ``ts`` as TIMESTAMP for streams (the NTZ wall clock read as UTC)."""
    e = readers.read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    return e.withColumn("ts", monitor.ntz_to_instant("ts"))


@query
def q_reward_monitor(spark, sf_dir):
    # windows on the TIMESTAMP_NTZ column itself: wall-clock days, whatever the session time zone
    e = readers.read_table(spark, sf_dir, "events", ["ts", "value"])
    m = monitor.reward_monitor(e, "ts", "value", "1 day")
    return m.select(F.col("window_start").cast("string").alias("window_start"), "n", "mean_reward")


@query
def q_length_monitor(spark, sf_dir):
    """AGG9: mean reward and mean episode length per sliding window."""
    e = readers.read_table(spark, sf_dir, "events", ["event_id", "ts", "value"])
    e = e.withColumn("turns", F.col("event_id") % 5 + 1)
    m = monitor.reward_monitor(e, "ts", "value", "2 days", "1 day", "turns")
    return m.select(F.col("window_start").cast("string").alias("window_start"), "n", "mean_reward", "mean_length")


# ---------------------------------------------------------------- documented SQL shapes
@query
def q_count_filter(spark, sf_dir):
    c = readers.read_table(spark, sf_dir, "customer", ["c_acctbal"])
    return c.filter(F.col("c_acctbal") > 1000).agg(F.count(F.lit(1)).alias("n"))


@query
def q_above_avg(spark, sf_dir):
    c = readers.read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal"])
    avg = c.agg(F.avg("c_acctbal")).scalar()
    return c.filter(F.col("c_acctbal") > avg).select("c_custkey", "c_name")


@query
def q_point_lookup(spark, sf_dir):
    o = readers.read_table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderkey") == 7).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def q_top_n(spark, sf_dir):
    o = readers.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(20)


@query
def q_in_list(spark, sf_dir):
    """JOIN8: ids from a limited, ordered subquery, then an IN lookup
    (a left-semi join on a 20-row side)."""
    c = readers.read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    ids = c.filter(F.col("c_nationkey") == 5).orderBy("c_custkey").limit(20).select(F.col("c_custkey").alias("o_custkey"))
    o = readers.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return o.join(F.broadcast(ids), "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


# ---------------------------------------------------------------- sinks / batches
@query
def q_sink_jsonl(spark, sf_dir):
    """SNK1 + SET4: JSON Lines in two batches, the second delivered twice; every committed record as read back."""
    path = scratch_path(spark, "rlaif_jsonl")
    recs = convert.rlaif_convert(S.articles(spark, sf_dir)).drop("ordinal")
    more = convert.rlvr_convert(S.code_problems(spark, sf_dir)).select(*recs.columns)
    for batch_id, rows in (("articles", recs), ("problems", more), ("problems", more)):
        batches.append_batch(rows, path, batch_id)
    back = batches.read_batches(spark, path, convert.TRAINING_RECORD)
    return back.select("data_source", F.col("prompt")[0]["content"].alias("content"), "ability",
                       F.col("reward_model.style").alias("style"), F.col("reward_model.ground_truth").alias("ground_truth"))


@query
def q_sink_prompt(spark, sf_dir):
    path = scratch_path(spark, "mtrl_prompts")
    m = convert.mtrl_convert(_questions(spark, sf_dir), S.available_dbs(spark, sf_dir), _corpus(spark, sf_dir))
    tagged, obs = readers.observe_counts(m, "mtrl", "reason", ["converted"])
    readers.write_prompt_parquet(tagged, path)
    return spark.read.parquet(path)


SAMPLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("data_source", T.StringType()),
    T.StructField("prompt", T.ArrayType(T.StructType([T.StructField("role", T.StringType()),
                                                      T.StructField("content", T.StringType())]))),
    T.StructField("response", T.StringType()),
    T.StructField("reward_model", T.StructType([T.StructField("style", T.StringType()),
                                                T.StructField("ground_truth", T.StringType())])),
    T.StructField("sample_ord", T.LongType())])


@query
def q_score_batch(spark, sf_dir):
    """SRC7 + FN27: batches of at most 128 samples, JSON arrays (single samples
    as a bare object), many to a file, read back, scored, order kept by
    ``sample_ord``."""
    s = S.judge_samples(spark, sf_dir).select(*SAMPLE_SCHEMA.fieldNames())
    batch = (F.col("sample_ord") / 128).cast("bigint")
    grouped = s.groupBy(batch.alias("batch")).agg(F.collect_list(F.struct(*SAMPLE_SCHEMA.fieldNames())).alias("items"))
    text = F.when(F.size("items") == 1, F.to_json(F.col("items")[0])).otherwise(F.to_json("items"))
    path = scratch_path(spark, "score_batches")
    grouped.select(text.alias("value")).write.mode("overwrite").text(path)
    back = readers.read_scoring_batches(spark, path, SAMPLE_SCHEMA, whole_files=False)
    r = judge_reward.judge_rewards(back, S.judge_replies(spark, sf_dir))
    return r.select("id", "sample_ord", "aggregate_reward_score")


@query
def q_score_array(spark, sf_dir):
    """SRC7: samples in large JSON array files, one of each writer, each read by many tasks over byte ranges."""
    s = S.judge_samples(spark, sf_dir).select(*SAMPLE_SCHEMA.fieldNames())
    path = scratch_path(spark, "score_arrays")

    def array_lines(batches):
        lead = "["
        for batch in batches:
            texts = batch.column(0).cast(pa.string())
            if len(texts):
                leads = pa.array([lead] + [","] * (len(texts) - 1))
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(leads, texts, "")], ["value"])
                lead = ","
        yield pa.RecordBatch.from_pydict({"value": ["[]" if lead == "[" else "]"]})

    s.select(F.to_json(F.struct(*SAMPLE_SCHEMA.fieldNames())).alias("value")).mapInArrow(array_lines, "value string").write.text(path)
    back = arrays.read_json_array(spark, path, SAMPLE_SCHEMA, range_bytes=1 << 20)
    r = judge_reward.judge_rewards(back, S.judge_replies(spark, sf_dir))
    return r.select("id", "sample_ord", "aggregate_reward_score")


# ---------------------------------------------------------------- plug-ins
@query
def q_reward_presets(spark, sf_dir):
    """UDF1 + UDF2: a preset by name, through the contract check."""
    presets = plugins.registry(outcomes=S.test_outcomes(spark, sf_dir))
    return plugins.with_reward(S.code_samples(spark, sf_dir), "correctness", presets).select("id", "aggregate_reward_score")


def _length_score(sample: dict) -> tuple[float, list[tuple[str, float, str]]]:
    if not sample["response"].strip():
        raise ValueError("no response")
    n = len(sample["response"])
    return min(n, 1000) / 1000, [("chars", n, "Metric")]


@query
def q_reward_plugin(spark, sf_dir):
    """UDF3: a Python scorer per partition; it raises for blank responses, which cost themselves the score and nothing else."""
    scored = plugins.with_reward(S.judge_samples(spark, sf_dir), plugins.partition_scorer(_length_score, ["id", "response"]))
    return scored.select("id", "aggregate_reward_score", F.try_element_at("metrics_list", F.lit(1))["value"].alias("chars"), "error")


# ---------------------------------------------------------------- streams
def _stream_time(ordinal):
    """Event times of samples: within half an hour, whatever their number."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ordinal % 1800)


@query
def q_stream_score(spark, sf_dir):
    """STR1 in three runs: all samples with the replies to every other one; the rest of the replies; rows of the next day,
    which end the wait for replies that never come."""
    samples = S.judge_samples(spark, sf_dir).select(*SAMPLE_SCHEMA.fieldNames()).withColumn("ts", _stream_time(F.col("sample_ord")))
    ten = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10))
    replies = S.judge_replies(spark, sf_dir).withColumn("ts", _stream_time(F.col("sample_id").cast("bigint")) + ten)
    next_day = spark.createDataFrame([(datetime(2024, 1, 2),)], "ts timestamp")
    even = F.col("sample_id").cast("bigint") % 2 == 0
    paths = {n: scratch_path(spark, n) for n in ("judge_in", "replies_in", "judge_out", "judge_ckpt")}
    for some, answered in ((samples, replies.filter(even)), (samples.limit(0), replies.filter(~even)), (next_day, next_day)):
        samples.limit(0).unionByName(some, allowMissingColumns=True).write.mode("append").parquet(paths["judge_in"])
        replies.limit(0).unionByName(answered, allowMissingColumns=True).write.mode("append").parquet(paths["replies_in"])
        scores = streams.stream_judge_scores(spark.readStream.schema(samples.schema).parquet(paths["judge_in"]),
                                             spark.readStream.schema(replies.schema).parquet(paths["replies_in"]))
        streams.run_available_now(scores.select("id", "sample_ord", "aggregate_reward_score"), paths["judge_out"], paths["judge_ckpt"])
    return spark.read.parquet(paths["judge_out"]).filter("id is not null")


@query
def q_stream_dedup(spark, sf_dir):
    """STR4: every sample is delivered twice in one micro-batch, and again in a later run."""
    s = S.judge_samples(spark, sf_dir).select("id", "sample_ord", "response")
    once = s.withColumn("ts", _stream_time(F.col("sample_ord")))
    src, sink, ckpt = (scratch_path(spark, n) for n in ("dedup_in", "dedup_out", "dedup_ckpt"))
    for delivery in (once.unionByName(once), once):
        delivery.write.mode("append").parquet(src)
        stream = spark.readStream.schema(once.schema).parquet(src)
        streams.run_available_now(streams.dedup_by_id(stream, "ts"), sink, ckpt)
    return spark.read.parquet(sink).select("id", "sample_ord")


#: Micro-batches that the questions come in.
MICRO_BATCHES = 4


@query
def q_stream_counts(spark, sf_dir):
    """SNK3 in a stream: the text-to-SQL converter's counters, gathered by micro-batch while the prompts are written.
    Each micro-batch is a quarter of the questions, in as many files as a quarter of their scan has splits."""
    q = _questions(spark, sf_dir)
    files = -(-q.rdd.getNumPartitions() // MICRO_BATCHES)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("questions_in", "prompts_out", "prompts_ckpt"))
    q.repartition(MICRO_BATCHES * files, "ordinal").write.parquet(src)
    stream = spark.readStream.schema(q.schema).option("maxFilesPerTrigger", files).parquet(src)
    tagged = convert.mtrl_tagged(stream, S.available_dbs(spark, sf_dir), _corpus(spark, sf_dir))
    reasons = ["converted", "skipped_empty", "skipped_missing_db"]
    observed, counters = streams.counted(tagged.select("reason", "prompt"), f"mtrl-{uuid.uuid4().hex}", "reason", reasons)
    try:
        streams.run_available_now(observed.filter("reason = 'converted'").select("prompt"), sink, ckpt)
        totals = counters.totals()
    finally:
        spark.streams.removeListener(counters)
    return spark.createDataFrame([(c, totals.get(c, 0)) for c in [*reasons, "rows"]], "counter string, n long")


@query
def q_stream_lengths(spark, sf_dir):
    """STR3 with episode lengths: mean reward and mean length by day, as the stream's updates leave them."""
    ev = _events_ts(spark, sf_dir).withColumn("turns", F.col("event_id") % 5 + 1).select("ts", "value", "turns")
    src = streams.stage_table(spark, ev, "events_in")
    table = scratch_path(spark, "lengths_table")
    windows = streams.windowed_monitor(spark.readStream.schema(ev.schema).parquet(src), "ts", "value", length_col="turns")
    streams.run_complete_to_table(windows, table, scratch_path(spark, "lengths_ckpt"))
    m = spark.read.parquet(table)
    return m.select(monitor.instant_to_utc_text("window_start").alias("window_start"), "n", "mean_reward", "mean_length")


@query
def q_stream_monitor(spark, sf_dir):
    ev = _events_ts(spark, sf_dir)
    src = streams.stage_table(spark, ev, "events_in")
    stream = spark.readStream.schema(ev.schema).parquet(src)
    table = scratch_path(spark, "monitor_table")
    streams.run_complete_to_table(streams.windowed_monitor(stream, "ts", "value"), table,
                                  scratch_path(spark, "monitor_ckpt"))
    m = spark.read.parquet(table)
    return m.select(monitor.instant_to_utc_text("window_start").alias("window_start"), "n", "mean_reward")


@query
def q_stream_monitor_append(spark, sf_dir):
    """STR3 in append mode, sliding: a far later row closes the windows, and a
    second delivery of all rows then comes too late to count."""
    ev = _events_ts(spark, sf_dir).select("ts", "value")
    src, sink, ckpt = (scratch_path(spark, n) for n in ("events_in", "monitor_out", "monitor_ckpt"))
    low, high = ev.agg(F.min("ts"), F.max("ts")).first()
    if low is None:
        return spark.createDataFrame([], "window_start string, n long, mean_reward double")
    later = spark.createDataFrame([(high + timedelta(days=30), 0.0)], ev.schema)
    for part in (ev.unionByName(later), ev):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(ev.schema).parquet(src)
        streams.run_available_now(streams.windowed_monitor(stream, "ts", "value", "2 days", slide="1 day"), sink, ckpt)
    m = spark.read.parquet(sink)
    return m.select(monitor.instant_to_utc_text("window_start").alias("window_start"), "n", "mean_reward")


@query
def q_stream_episodes(spark, sf_dir):
    """STR2, fed in three runs over growing parts of the time range; each resumes
    from the checkpoint, and a row without an episode id closes the last one."""
    t = _traj(spark, sf_dir)
    low, high = t.agg(F.min("ts"), F.max("ts")).first()
    src, sink, ckpt = (scratch_path(spark, n) for n in ("traj_in", "episodes_out", "episodes_ckpt"))
    if low is None:
        return spark.createDataFrame([], streams.EPISODE_OUT)
    cuts = [low, low + (high - low) / 3, low + (high - low) * 2 / 3, None]
    for start, end in zip(cuts, cuts[1:]):
        part = t.filter((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end) if end else F.lit(True)))
        if end is None:
            part = part.unionByName(spark.createDataFrame([(high + (high - low) + timedelta(days=1),)], "ts timestamp"),
                                    allowMissingColumns=True)
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(t.schema).parquet(src)
        streams.run_available_now(streams.assemble_episodes(streams.annotate_turns(stream)), sink, ckpt)
    return spark.read.parquet(sink)
