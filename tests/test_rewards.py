"""Worked values of the two scorers (FIXTURES §2) and their edge cases."""

import json

import pytest
from pyspark.sql import functions as F

from rewardlake.operators import code_reward, judge_reward
from rewardlake.functions.jsonfns import tool_args_sql

SAMPLE = ("id string, data_source string, prompt array<struct<role:string,content:string>>, response string, "
          "reward_model struct<style:string,ground_truth:string>, "
          "extra_info struct<reference_answer:struct<text:string>>, sample_ord bigint")


def code_row(i, response, gt, ref=None):
    return (i, "mbpp", [("user", "x")], response, ("rule", gt), ((ref,),), ord(i[0]))


def test_rlvr_worked_value(spark):
    code = "\n".join(f"x{i} = {i}" for i in range(20))
    gt = json.dumps([f"assert f({i}) == {i}" for i in range(4)])
    s = spark.createDataFrame([code_row("1", f"```python\n{code}\n```", gt)], SAMPLE)
    o = spark.createDataFrame([("1", 0, True), ("1", 1, True), ("1", 2, True), ("1", 3, False), ("1", 9, True)],
                              "sample_id string, test_idx int, passed boolean")
    r = code_reward.rlvr_rewards(s, o).first()
    assert r["aggregate_reward_score"] == 0.72
    assert [m["name"] for m in r["metrics_list"]] == ["correctness", "conciseness", "tests_passed", "code_lines"]
    assert r["passed"] == 3 and r["total"] == 4 and r["code_lines"] == 20


def test_rlvr_short_circuits_and_fallback(spark):
    gt_b = json.dumps({"fn_name": "f", "inputs": ["1\n2", "[1, 2]", "bad json", "3"], "outputs": ["3", "[2, 1]", "1"]})
    rows = [code_row("a", "x = 1", "not json"), code_row("b", "   ", json.dumps(["assert f() == 1"])),
            code_row("c", "x = 1", "", gt_b), code_row("d", "x = 1", json.dumps({"fn_name": "", "inputs": ["1"], "outputs": ["1"]}))]
    s = spark.createDataFrame(rows, SAMPLE)
    o = spark.createDataFrame([("c", 0, True), ("c", 1, True)], "sample_id string, test_idx int, passed boolean")
    r = {x["id"]: x for x in code_reward.rlvr_rewards(s, o).collect()}
    assert r["a"]["aggregate_reward_score"] == 0.0 and r["a"]["metrics_list"] is None
    assert r["b"]["aggregate_reward_score"] == 0.0 and r["b"]["metrics_list"] is None
    assert r["d"]["aggregate_reward_score"] == 0.0
    # zip truncates to the shorter list, the pair with bad JSON is skipped -> 2 tests, both pass
    assert r["c"]["total"] == 2 and r["c"]["passed"] == 2
    assert r["c"]["aggregate_reward_score"] == 1.0
    g = {x["id"]: x["gt_source"] for x in code_reward.ground_truth_text(s).collect()}
    assert g == {"a": "reward_model", "b": "reward_model", "c": "reference_answer", "d": "reward_model"}


def judge_rows(spark, response, reply):
    s = spark.createDataFrame([("1", "cnn", [("user", "Sum.\n\nArticle:\nBody.")], response, ("llmj", "ref"), None, 1)],
                              SAMPLE)
    r = spark.createDataFrame([("1", reply)], "sample_id string, judge_text string")
    return judge_reward.judge_rewards(s, r).first()


def test_judge_not_json_three_sentences(spark):
    r = judge_rows(spark, "A one. B two. C three.", "I liked it")
    assert r["aggregate_reward_score"] == 0.6
    assert [m["value"] for m in r["metrics_list"]][:5] == [3.0, 3.0, 3.0, 5.0, 3.0]


def test_judge_one_sentence(spark):
    assert judge_rows(spark, "Only one.", None)["aggregate_reward_score"] == 0.4


def test_judge_empty_response(spark):
    r = judge_rows(spark, "  ", '{"faithfulness": 5}')
    assert r["aggregate_reward_score"] == 0.0
    assert [(m["name"], m["value"]) for m in r["metrics_list"]] == [(d, 0.0) for d in judge_reward.DIMENSIONS]


def test_judge_fenced_and_missing_keys(spark):
    r = judge_rows(spark, "A. B.", 'ok\n```json\n{"faithfulness": 5, "coverage": 1, "no_redundancy": 2, '
                                   '"appropriate_length": 1, "coherence": 4}\n```')
    assert (r["faithfulness"], r["coverage"], r["no_redundancy"], r["appropriate_length"], r["coherence"]) == (5, 1, 2, 5, 4)
    r = judge_rows(spark, "A. B.", '{"faithfulness": "4", "coverage": 5} trailing')
    assert (r["faithfulness"], r["coverage"]) == (3.0, 3.0)  # not one JSON object -> neutral
    r = judge_rows(spark, "A. B.", '{"faithfulness": 9, "coverage": 5, "no_redundancy": 5, "coherence": 5}')
    assert r["out_of_range"] and r["aggregate_reward_score"] == 1.2


@pytest.mark.parametrize("args,expected", [
    ("  SELECT 1 ", "SELECT 1"), ('{"sql": " SELECT 2"}', "SELECT 2"), ('{"query": "Q", "sql": "S"}', "S"),
    ('{"limit": 5, "text": "T", "other": "U"}', "T"), ('"SELECT 3"', "SELECT 3"), ("[1, 2]", None),
    ('{"statement": "X", "query": 3}', "X"), ('{"a": 1}', None), ("", None)])
def test_tool_call_arguments(spark, args, expected):
    df = spark.createDataFrame([(args,)], "a string")
    assert df.select(tool_args_sql(F.col("a")).alias("r")).first()["r"] == expected


def test_duplicate_outcomes_count_once(spark):
    gt = json.dumps(["assert f(1) == 1", "assert f(2) == 2"])
    s = spark.createDataFrame([code_row("7", "x = 1", gt)], SAMPLE)
    o = spark.createDataFrame([("7", 0, True), ("7", 0, True), ("7", 1, False), ("7", 1, True)],
                              "sample_id string, test_idx int, passed boolean")
    r = code_reward.rlvr_rewards(s, o).first()
    assert r["total"] == 2 and r["passed"] == 2
