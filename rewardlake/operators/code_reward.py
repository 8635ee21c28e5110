"""Rule reward for generated code: test outcomes + conciseness (RLVR scorer).

Running untrusted code stays outside Spark; its outcomes arrive as a table
``(sample_id, test_idx, passed)`` and are joined to the samples here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import conciseness, extract_code, nonblank_lines, py_strip
from ..session import materialize

# ---- fixed values of the reference scorer ----
CORRECTNESS_WEIGHT, CONCISENESS_WEIGHT = 0.8, 0.2
# ----------------------------------------------

METRIC = "struct<name:string,value:double,type:string>"


def metric(name: str, value: Column, kind: str) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(kind).alias("type"))


def ground_truth_text(samples: DataFrame) -> DataFrame:
    """FLT9: reward_model.ground_truth, else extra_info.reference_answer.text."""
    rm = F.col("reward_model.ground_truth")
    ref = F.col("extra_info.reference_answer.text")
    src = (F.when(F.coalesce(rm, F.lit("")) != "", F.lit("reward_model"))
            .when(F.coalesce(ref, F.lit("")) != "", F.lit("reference_answer"))
            .otherwise(F.lit("none")))
    return samples.withColumn("gt_source", src).withColumn(
        "gt", F.when(src == "reward_model", rm).when(src == "reference_answer", ref).otherwise(F.lit("")))


def _arg_list(inp: Column, strict_reference: bool) -> Column:
    pieces = F.split(inp, "\n")
    if strict_reference:
        return pieces
    return F.when(inp == "", F.array().cast("array<string>")).otherwise(pieces)


_TEST = "struct<test_idx:int,assertion:string,fn_name:string,args:array<string>,expected:string>"
_OBJ = "fn_name string, inputs array<variant>, outputs array<variant>"


def with_tests(df: DataFrame, gt_col: str = "gt", out_col: str = "tests",
               strict_reference: bool = False) -> DataFrame:
    """FN7 + JOIN3: adds ARRAY<STRUCT<test_idx, assertion, fn_name, args, expected>>.

    A JSON list gives one test per element; a JSON object with non-empty
    fn_name / inputs / outputs gives the zip of inputs and outputs truncated
    to the shorter one, keeping pairs of two strings whose parts all parse as
    JSON; of a repeated key the last value counts.  Anything else gives no
    tests.  ``""`` as input means "no arguments" unless ``strict_reference``
    reproduces the reference's drop.
    """
    t = py_strip(gt_col)
    d = df.withColumn("_gt_v", F.when(t.rlike(r"(?s)^\[.*\]$"), F.try_parse_json(t))) \
          .withColumn("_gt_obj", F.when(t.rlike(r"(?s)^\{.*\}$"), F.from_json(t, _OBJ, {"allowSingleQuotes": "false"})))
    items = F.try_variant_get("_gt_v", "$", "array<variant>")
    text_of = lambda x: F.when(F.schema_of_variant(x) == "STRING", F.variant_get(x, "$", "string"))
    d = d.withColumn("_gt_list", F.transform(items, lambda x: F.coalesce(text_of(x), F.to_json(x))))
    obj = F.col("_gt_obj")
    ok_obj = (F.coalesce(obj["fn_name"], F.lit("")) != "") & (F.coalesce(F.size(obj["inputs"]), F.lit(0)) > 0) \
        & (F.coalesce(F.size(obj["outputs"]), F.lit(0)) > 0)
    n = F.least(F.size(obj["inputs"]), F.size(obj["outputs"]))
    pairs = F.slice(F.arrays_zip(F.transform(obj["inputs"], text_of).alias("inp"),
                                 F.transform(obj["outputs"], text_of).alias("out")), 1, n)
    valid = F.filter(pairs, lambda p: p["inp"].isNotNull() & p["out"].isNotNull()
                     & F.forall(_arg_list(p["inp"], strict_reference), lambda a: F.try_parse_json(a).isNotNull())
                     & F.try_parse_json(p["out"]).isNotNull())
    from_obj = F.transform(valid, lambda p, i: F.struct(
        i.alias("test_idx"), F.lit(None).cast("string").alias("assertion"), obj["fn_name"].alias("fn_name"),
        _arg_list(p["inp"], strict_reference).alias("args"), p["out"].alias("expected")))
    from_list = F.transform("_gt_list", lambda x, i: F.struct(
        i.alias("test_idx"), x.alias("assertion"), F.lit(None).cast("string").alias("fn_name"),
        F.lit(None).cast("array<string>").alias("args"), F.lit(None).cast("string").alias("expected")))
    tests = (F.when(F.col("_gt_list").isNotNull(), from_list)
              .when(obj.isNotNull() & ok_obj, from_obj)
              .otherwise(F.array().cast(f"array<{_TEST}>")))
    return d.withColumn(out_col, tests).drop("_gt_v", "_gt_list", "_gt_obj")


def zip_tests(samples: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Long table of parsed tests: (sample_id, test_idx, assertion, fn_name, args, expected).

    An outer ``inline``, for the reason given in ``convert.assertion_table``."""
    g = with_tests(ground_truth_text(samples), "gt", "t", strict_reference)
    return g.select(F.col("id").alias("sample_id"), F.inline_outer("t")).filter(F.col("test_idx").isNotNull())


def correctness(outcomes: DataFrame, totals: DataFrame) -> DataFrame:
    """AGG1: passed tests per sample of ``totals`` (id, total).

    Every sample's test numbers are joined to the outcomes on (sample, test):
    outcomes of tests that are not in the list find no partner, a missing
    outcome counts as a failure, and a sample with very many outcomes is
    spread by test.  A test reported more than once (re-delivery, retried run)
    counts once: one verdict per (sample, test) first, combined before the
    shuffle."""
    per_test = outcomes.groupBy("sample_id", "test_idx").agg(F.bool_or("passed").alias("passed"))
    tests = totals.filter("total > 0").select(F.col("id").alias("sample_id"),
                                              F.explode(F.sequence(F.lit(0), F.col("total") - 1)).alias("test_idx"))
    return tests.join(per_test.filter("passed"), ["sample_id", "test_idx"]).groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("passed"))


def scored_parts(samples: DataFrame, strict_reference: bool = False) -> DataFrame:
    """(id, sample_ord, total, code_lines, blank): all that the score needs of a sample's texts."""
    s = with_tests(ground_truth_text(samples), "gt", "_tests", strict_reference)
    s = s.select("id", "sample_ord", F.size("_tests").alias("total"), extract_code("response").alias("code"))
    return s.select("id", "sample_ord", "total", nonblank_lines("code").alias("code_lines"), (F.col("code") == "").alias("blank"))


def rlvr_rewards(samples: DataFrame, outcomes: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Reward record per sample: FLT7 short-circuits, AGG1, FN2/FN3, AGG3, PRJ4/PRJ5.

    Output: id, sample_ord, aggregate_reward_score, metrics_list, plus the
    parts (total, passed, correctness, conciseness, code_lines).  The texts are
    read once, into a narrow table that both joins start from.
    """
    s = materialize(samples.sparkSession, scored_parts(samples, strict_reference), "code-parts")
    passed = correctness(outcomes, s)
    j = s.join(passed, s.id == passed.sample_id, "left")
    total, lines = F.col("total"), F.col("code_lines")
    p = F.coalesce(F.col("passed"), F.lit(0))
    corr = F.when(total > 0, p / total).otherwise(F.lit(0.0))
    conc = conciseness(lines)
    zero = (total == 0) | F.col("blank")
    score = F.when(zero, F.lit(0.0)).otherwise(
        F.bround(F.lit(CORRECTNESS_WEIGHT) * corr + F.lit(CONCISENESS_WEIGHT) * conc, 4))
    metrics = F.when(zero, F.lit(None).cast(f"array<{METRIC}>")).otherwise(F.array(
        metric("correctness", corr, "Reward"), metric("conciseness", conc, "Metric"),
        metric("tests_passed", p, "Metric"), metric("code_lines", lines, "Metric")))
    return j.select("id", "sample_ord", score.alias("aggregate_reward_score"), metrics.alias("metrics_list"),
                    total.alias("total"), p.alias("passed"),
                    F.when(zero, F.lit(None)).otherwise(corr).alias("correctness"),
                    F.when(zero, F.lit(None)).otherwise(conc).alias("conciseness"),
                    F.when(zero, F.lit(None)).otherwise(lines).alias("code_lines"))


def metrics_long(rewards: DataFrame) -> DataFrame:
    """PRJ5: (id, metric_idx, name, value, type) from ``metrics_list``."""
    return rewards.select("id", F.posexplode("metrics_list").alias("metric_idx", "m")) \
                  .select("id", "metric_idx", "m.name", "m.value", "m.type")
