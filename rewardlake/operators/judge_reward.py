"""Judge-based reward for summaries (RLAIF scorer).

The judge model is external: ``judge_requests`` produces the request table
for the samples that need a judge, and its replies come back as a table
``(sample_id, judge_text)`` with NULL for a failed call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonfns import guarded_from_json
from ..functions.text import (FENCE_JSON, JUDGE_ARTICLE_CHARS, JUDGE_REFERENCE_CHARS, article_from_prompt,
                              length_rule, py_strip, summary_sentences, unwrap_fence)
from .code_reward import METRIC, metric

# ---- fixed values of the reference scorer ----
DIMENSIONS = ("faithfulness", "coverage", "no_redundancy", "appropriate_length", "coherence")
NEUTRAL_SCORE = 3.0          # missing dimension or failed judge call
LENGTH_PASS, LENGTH_FAIL = 5.0, 1.0
# ----------------------------------------------

# our own default judge instructions; {article} {summary} {reference} are filled in
JUDGE_TEMPLATE = (
    "Rate the summary of a news article on five criteria, each from 1 (poor) to 5 (excellent): "
    "faithfulness, coverage, no_redundancy, appropriate_length and coherence.\n\n"
    "ARTICLE:\n{article}\n\nSUMMARY TO RATE:\n{summary}\n\nREFERENCE SUMMARY:\n{reference}\n\n"
    "Reply with one JSON object holding the five integer scores and nothing else.")

_SCORES = ", ".join(f"{d} double" for d in DIMENSIONS)


def _fill(template: str, **cols: Column) -> Column:
    """Fill ``{name}`` slots of a template with columns (template is ours)."""
    parts: list[Column] = []
    rest = template
    while rest:
        i = rest.find("{")
        if i < 0:
            parts.append(F.lit(rest))
            break
        j = rest.index("}", i)
        if i:
            parts.append(F.lit(rest[:i]))
        parts.append(cols[rest[i + 1:j]])
        rest = rest[j + 1:]
    return F.concat(*parts)


def prepared(samples: DataFrame) -> DataFrame:
    """Response (stripped), article (FN8) and reference of each sample."""
    return samples.withColumn("summary", py_strip(F.coalesce(F.col("response"), F.lit("")))) \
                  .withColumn("article", article_from_prompt("prompt")) \
                  .withColumn("reference", F.coalesce(F.col("reward_model.ground_truth"), F.lit("")))


def judge_requests(samples: DataFrame, template: str = JUDGE_TEMPLATE) -> DataFrame:
    """PRJ8 + FLT8: request text for samples with a non-empty response only."""
    p = prepared(samples).filter(F.col("summary") != "")
    req = _fill(template, article=F.left("article", F.lit(JUDGE_ARTICLE_CHARS)), summary=F.col("summary"),
                reference=F.left("reference", F.lit(JUDGE_REFERENCE_CHARS)))
    return p.select("id", "sample_ord", req.alias("request"))


def parse_judge(judge_text: Column) -> Column:
    """FN12 + FN13: STRUCT of the five scores (DOUBLE); missing key, unusable
    value, non-JSON reply or failed call -> neutral 3."""
    body = unwrap_fence(py_strip(judge_text), FENCE_JSON)
    parsed = guarded_from_json(body, _SCORES)
    return F.struct(*[F.coalesce(parsed[d], F.lit(NEUTRAL_SCORE)).alias(d) for d in DIMENSIONS])


def measured(samples: DataFrame) -> DataFrame:
    """What a score needs of each sample, without its texts, and the stream's columns if there are any."""
    p = prepared(samples)
    return p.select("id", "sample_ord", *(c for c in ("ts",) if c in samples.columns), (F.col("summary") == "").alias("_empty"),
                    length_rule("summary").alias("_rule"), summary_sentences("summary").alias("_sentences"))


def scored(joined: DataFrame) -> DataFrame:
    """FLT7 (empty response), FN10/FN14 length override, AGG4, PRJ4/PRJ5 of
    ``measured`` samples joined to ``judge_text`` and ``_replied``.

    Scores are not clamped; ``out_of_range`` flags rewards outside [0, 1].
    ``judge_text`` NULL is a failed call (neutral scores); a sample without a
    reply is ``pending`` and has no score, unless its response is empty.
    """
    # parsed once into a column; the optimizer keeps it instead of inlining
    # the JSON parse into each of the many uses below
    j = joined.withColumn("_scores", parse_judge(F.col("judge_text")))
    s, rule, empty = F.col("_scores"), F.col("_rule"), F.col("_empty")
    dims = {d: s[d] for d in DIMENSIONS}
    dims["appropriate_length"] = F.when(rule == 1, F.lit(LENGTH_PASS)).otherwise(F.lit(LENGTH_FAIL))
    pending = ~empty & ~F.col("_replied")
    total = dims["faithfulness"] + dims["coverage"] + dims["no_redundancy"] + dims["appropriate_length"] + dims["coherence"]
    score = F.when(empty, F.lit(0.0)).otherwise(F.bround((total - F.lit(5.0)) / F.lit(20.0), 4))
    zeros = F.array(*[metric(d, F.lit(0.0), "Reward") for d in DIMENSIONS])
    full = F.array(*[metric(d, dims[d], "Reward") for d in DIMENSIONS],
                   metric("summary_sentences", F.col("_sentences"), "Metric"))
    metrics = F.when(empty, zeros).otherwise(full).cast(f"array<{METRIC}>")
    out = j.select("id", "sample_ord", F.when(~pending, score).alias("aggregate_reward_score"),
                   F.when(~pending, metrics).alias("metrics_list"), pending.alias("pending"),
                   *[F.when(empty, F.lit(0.0)).when(~pending, dims[d]).alias(d) for d in DIMENSIONS],
                   F.when(empty, F.lit(None)).otherwise(F.col("_sentences")).alias("summary_sentences"),
                   rule.alias("length_rule"))
    return out.withColumn("out_of_range", (F.col("aggregate_reward_score") < 0) | (F.col("aggregate_reward_score") > 1))


def judge_rewards(samples: DataFrame, replies: DataFrame) -> DataFrame:
    """Scores of samples with the replies there are (see ``scored``).  Of several
    replies to a sample one counts: a successful one, the least text of them."""
    replies = replies.groupBy(F.col("sample_id").alias("id")).agg(F.min("judge_text").alias("judge_text"))
    replies = replies.withColumn("_replied", F.lit(True))
    joined = measured(samples).join(replies, "id", "left")
    return scored(joined.withColumn("_replied", F.coalesce("_replied", F.lit(False))))
