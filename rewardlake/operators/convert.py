"""Dataset converters: raw tables -> training-prompt tables (three pipelines).

Each converter tags every input row with a ``reason`` ('converted' or a skip
reason) in one pass, so the same plan feeds the kept rows, the counters and
the first-N cap.
"""

from __future__ import annotations

import ast
import json
import operator
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonfns import messages
from ..functions.text import (ARTICLE_MARK, fn_name_from_tests, is_blank, py_strip, sentence_snap,
                              split_asserts)

# ---- fixed values of the reference records ----
RLAIF_DATA_SOURCE, RLAIF_ABILITY, RLAIF_STYLE = "cnn_dailymail", "summarization", "llmj"
RLVR_DATA_SOURCE, RLVR_ABILITY, RLVR_STYLE = "mbpp", "code", "rule"
MTRL_ENV_CLASS, MTRL_STYLE, MTRL_SPLIT = "text2sql", "rule", "train"
MIN_ARTICLE_CHARS, MIN_HIGHLIGHT_CHARS = 100, 20
RLAIF_MAX_SAMPLES, MTRL_MAX_SAMPLES = 5000, 500
DEFAULT_SCHEMA_TEXT = "-- Database: {db_id}\n-- WARNING: no schema.sql found; schema unknown"
# -----------------------------------------------

# ---- our own default instruction wording (parameters) ----
SUMMARY_INSTRUCTION = "Tell a reader in a hurry what this news story reports. Two to four sentences."
CODE_NAME_HINT = "The checks call `{fn}`, so define it under that name."
SQL_SYSTEM_PROMPT = (
    "You answer questions about a SQL database.\n"
    "Reason inside <think>...</think>. Run a query with <sql>...</sql>; its result comes back inside "
    "<observation>...</observation>. When you are sure, give the final query inside <solution>...</solution>. "
    "You have at most 5 turns; use only tables and columns from the schema.")
# -----------------------------------------------------------

TRAINING_RECORD = T.StructType([
    T.StructField("data_source", T.StringType()),
    T.StructField("prompt", T.ArrayType(T.StructType([T.StructField("role", T.StringType()),
                                                      T.StructField("content", T.StringType())]))),
    T.StructField("ability", T.StringType()),
    T.StructField("reward_model", T.StructType([T.StructField("style", T.StringType()),
                                                T.StructField("ground_truth", T.StringType())])),
])


# --------------------------------------------------------------------- RLAIF
def rlaif_tagged(articles: DataFrame, instruction: str = SUMMARY_INSTRUCTION) -> DataFrame:
    """FLT1 + FN9 + PRJ2: every article row with ``reason`` and the record."""
    a = py_strip("article")
    h = py_strip("highlights")
    short = F.coalesce((F.length(a) < MIN_ARTICLE_CHARS) | (F.length(h) < MIN_HIGHLIGHT_CHARS), F.lit(True))
    reason = F.when(short, F.lit("skipped_short")).otherwise(F.lit("converted"))
    content = F.concat(F.lit(instruction), F.lit("\n\n" + ARTICLE_MARK), sentence_snap(a))
    return articles.select(
        *(c for c in ("split_ord",) if c in articles.columns), "ordinal", reason.alias("reason"),
        F.lit(RLAIF_DATA_SOURCE).alias("data_source"),
        messages(("user", content)).alias("prompt"),
        F.lit(RLAIF_ABILITY).alias("ability"),
        F.struct(F.lit(RLAIF_STYLE).alias("style"), h.alias("ground_truth")).alias("reward_model"))


def source_order(df: DataFrame) -> list[str]:
    """The columns of source order: the split first, where there are splits."""
    return [c for c in ("split_ord", "ordinal") if c in df.columns]


def rlaif_convert(articles: DataFrame, max_samples: int | None = None) -> DataFrame:
    """Training records for summarisation (optionally the first N kept)."""
    tagged = rlaif_tagged(articles)
    kept = tagged.filter(F.col("reason") == "converted")
    if max_samples is not None:
        kept = first_n(kept, source_order(kept), max_samples)
    return kept.select(*source_order(kept), "data_source", "prompt", "ability", "reward_model")


# --------------------------------------------------------------------- LIM1
def _up_to_nth(rows: DataFrame, order: Sequence[str], n: int) -> Column:
    """Condition that holds for rows no later in ``order`` than the n-th of
    ``rows`` (for all, where there are fewer).

    Only the order's columns are dealt to ranges.  What each range holds is
    counted, one number a range; the counts, summed up, name the range that
    holds the n-th row, and that range alone is sorted.  So no task holds n
    rows, and no wide row moves.
    """
    from ..session import materialize
    if n <= 0:
        return F.lit(False)
    ranged = rows.select(*order).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(rows.sparkSession, ranged, "order")
    left = n
    for r, held in ranged.groupBy("_range").count().orderBy("_range").collect():
        if held >= left:
            last = ranged.filter(F.col("_range") == r).orderBy(*order).offset(left - 1).limit(1).first()
            break
        left -= held
    else:
        return F.lit(True)
    types = {f.name: f.dataType for f in rows.schema.fields}
    key = [F.lit(last[c]).cast(types[c]) for c in order]
    if len(order) == 1:
        return F.coalesce(F.col(order[0]) <= key[0], F.lit(True))  # nulls come first
    return F.struct(*order) <= F.struct(*(k.alias(c) for k, c in zip(key, order)))


def _names(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def first_n(kept: DataFrame, order: str | Sequence[str], n: int) -> DataFrame:
    """LIM1 / WIN4: the first ``n`` kept rows in source order, which may need
    several columns (split, ordinal) and must tell all rows apart."""
    return kept.filter(_up_to_nth(kept, _names(order), n))


def capped_stats(tagged: DataFrame, order: str | Sequence[str], n: int | None, kept_reason: str = "converted") -> DataFrame:
    """AGG7 under LIM1: per-reason counts of the rows the reference's loop
    looks at before it stops: those up to the n-th kept one (all rows when
    fewer than ``n`` are kept)."""
    if n is not None:
        kept = tagged.filter(F.col("reason") == kept_reason)
        tagged = tagged.filter(_up_to_nth(kept, _names(order), n))
    return tagged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------- RLVR
_CALLS = T.ArrayType(T.StructType([T.StructField("args", T.StringType()), T.StructField("expected", T.StringType())]))


def rlvr_structure(problems: DataFrame) -> DataFrame:
    """FN4 + FN5: function name and the structurally valid assertions
    (in test order) as (args text, expected text)."""
    fn = fn_name_from_tests("test_list")
    with_fn = problems.withColumn("fn_name", fn)
    calls = F.transform(F.filter(split_asserts("test_list", "fn_name"), lambda p: p["ok"]),
                        lambda p: F.struct(p["args"].alias("args"), p["expected"].alias("expected")))
    return with_fn.withColumn("calls", F.when(F.col("fn_name").isNotNull(), calls).otherwise(F.array().cast(_CALLS)))


#: Largest exponent and number of digits that arithmetic on literals may reach.
MOST_POWER, MOST_DIGITS = 64, 400
_ARITHMETIC = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv,
               ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod, ast.Pow: operator.pow}


def _number(node: ast.AST):
    """Value of arithmetic on number literals; anything else, or anything huge, is an error."""
    if isinstance(node, ast.Constant) and type(node.value) in (int, float):
        return node.value
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
        value = _number(node.operand)
        return -value if isinstance(node.op, ast.USub) else value
    if isinstance(node, ast.BinOp) and type(node.op) in _ARITHMETIC:
        left, right = _number(node.left), _number(node.right)
        if isinstance(node.op, ast.Pow) and abs(right) > MOST_POWER:
            raise ValueError("exponent out of bounds")
        value = _ARITHMETIC[type(node.op)](left, right)
        if isinstance(value, complex) or abs(value) >= 10 ** MOST_DIGITS:
            raise ValueError("value out of bounds")
        return value
    raise ValueError("not a literal")


def _value(node: ast.AST):
    """Value of a literal, in which numbers may be computed; anything else is an error."""
    if isinstance(node, ast.Constant):
        return node.value
    if isinstance(node, ast.Tuple):
        return tuple(map(_value, node.elts))
    if isinstance(node, ast.List):
        return list(map(_value, node.elts))
    if isinstance(node, ast.Dict):
        return {_value(k): _value(v) for k, v in zip(node.keys, node.values, strict=True)}
    return _number(node)


_PARSE = ast.PyCF_ONLY_AST


def _is_int(text: str) -> bool:
    return text.isascii() and text.isdecimal() and (text[0] != "0" or len(text) == 1) and len(text) < 4000


def _literal_args(args_text: str) -> str:
    """Positional literal arguments of ``f(<args_text>)`` as newline-joined
    JSON (keyword arguments are ignored, as in the reference)."""
    plain = args_text.split(", ")
    if all(map(_is_int, plain)):
        return "\n".join(plain)
    node = compile(f"_f({args_text})", "", "eval", _PARSE).body
    if not isinstance(node, ast.Call):
        raise ValueError("not a single call")
    vals = []
    for a in node.args:
        if isinstance(a, ast.Starred):
            raise ValueError("starred argument")
        vals.append(_value(a))
    return "\n".join(json.dumps(v) for v in vals)


def _literal_value(text: str) -> str:
    if _is_int(text):
        return text
    v = _value(compile(text.strip(), "", "eval", _PARSE).body)
    if isinstance(v, tuple):
        v = list(v)
    return json.dumps(v)


def parse_literals(calls) -> tuple[list[str], list[str]]:
    """FN6: keep assertions whose arguments and expected value are literals
    that JSON can encode; returns (inputs, outputs)."""
    calls = calls if calls is not None else []
    return parse_literal_pairs([c["args"] for c in calls], [c["expected"] for c in calls])


def parse_literal_pairs(args, expected) -> tuple[list[str], list[str]]:
    ins, outs = [], []
    for a, e in zip(args if args is not None else [], expected if expected is not None else []):
        try:
            i, o = _literal_args(a), _literal_value(e)
        except Exception:  # noqa: BLE001 - any non-literal / non-JSON value drops the test
            continue
        ins.append(i)
        outs.append(o)
    return ins, outs


_PARSED = T.StructType([T.StructField(c, T.ArrayType(T.StringType())) for c in ("inputs", "outputs")])


def _parse_batch(calls: pa.Array) -> pa.Array:
    rows = [parse_literals(c) for c in calls.to_pylist()]
    text = pa.list_(pa.string())
    return pa.array([{"inputs": i, "outputs": o} for i, o in rows], pa.struct([("inputs", text), ("outputs", text)]))


def rlvr_literals(structured: DataFrame) -> DataFrame:
    """UDF4: literal parsing in Arrow batches; only the calls' texts leave the JVM.

    Parsing has no side effects, but it is marked as if it might, or filters on
    its results would be pushed below it together with a second run of it."""
    parse = F.arrow_udf(_parse_batch, _PARSED).asNondeterministic()
    parsed = structured.withColumn("_io", parse(F.col("calls")))
    return parsed.withColumn("inputs", F.col("_io.inputs")).withColumn("outputs", F.col("_io.outputs")).drop("_io", "calls")


def rlvr_tagged(problems: DataFrame, name_hint: str = CODE_NAME_HINT) -> DataFrame:
    """FLT4/FLT5 + AGG2 + PRJ1 + FN24: every problem with reason and record."""
    lit = rlvr_literals(rlvr_structure(problems))
    reason = (F.when(F.col("fn_name").isNull(), F.lit("skipped_no_function"))
               .when(F.size("inputs") == 0, F.lit("skipped_no_tests"))
               .otherwise(F.lit("converted")))
    hint = F.replace(F.lit(name_hint), F.lit("{fn}"), F.coalesce(F.col("fn_name"), F.lit("")))
    gt = F.to_json(F.struct("fn_name", "inputs", "outputs"))
    return lit.select(
        "problem_id", reason.alias("reason"), "fn_name", "inputs", "outputs",
        F.lit(RLVR_DATA_SOURCE).alias("data_source"),
        messages(("user", F.concat(F.col("prompt"), F.lit("\n\n"), hint))).alias("prompt"),
        F.lit(RLVR_ABILITY).alias("ability"),
        F.struct(F.lit(RLVR_STYLE).alias("style"), gt.alias("ground_truth")).alias("reward_model"))


def rlvr_convert(problems: DataFrame) -> DataFrame:
    return rlvr_tagged(problems).filter(F.col("reason") == "converted")


def assertion_table(problems: DataFrame) -> DataFrame:
    """FLT5 as a long table: (problem_id, test_idx, fn_name, args, expected)
    of the structurally valid assertions.

    From an outer explode no filter on the calls' number is inferred, which
    would be pushed to the scan and there work out every text anew at each use."""
    s = rlvr_structure(problems)
    return s.select("problem_id", "fn_name", F.posexplode_outer("calls").alias("test_idx", "call")) \
            .filter(F.col("test_idx").isNotNull()).select("problem_id", "test_idx", "fn_name", F.col("call.args").alias("args"),
                    F.col("call.expected").alias("expected"))


# --------------------------------------------------------------------- MTRL
def default_schema_text(db_id) -> F.Column:
    """FN25: two comment lines used when a database has no schema."""
    return F.replace(F.lit(DEFAULT_SCHEMA_TEXT), F.lit("{db_id}"), db_id)


def semi_available(questions: DataFrame, available: DataFrame) -> DataFrame:
    """JOIN1: questions whose db is bundled (left-semi; Spark sizes the build
    side at run time and broadcasts it only when it is small)."""
    return questions.join(available.select("db_id"), "db_id", "left_semi")


def anti_missing(questions: DataFrame, available: DataFrame) -> DataFrame:
    """JOIN1 complement: questions whose db is not bundled (left-anti)."""
    return questions.join(available.select("db_id"), "db_id", "left_anti")


def with_schema(questions: DataFrame, corpus: DataFrame) -> DataFrame:
    """JOIN2: left join to the schema corpus with the default text."""
    return (questions.join(corpus.select("db_id", "ddl"), "db_id", "left")
            .withColumn("schema", F.coalesce(F.col("ddl"), default_schema_text(F.col("db_id")))).drop("ddl"))


def mtrl_tagged(questions: DataFrame, available: DataFrame, corpus: DataFrame,
                system_prompt: str = SQL_SYSTEM_PROMPT) -> DataFrame:
    """FLT2 -> FLT3 -> JOIN2 -> PRJ3 with the reason of every question."""
    avail = available.select("db_id").distinct().withColumn("_avail", F.lit(True))
    q = questions.join(avail, "db_id", "left")
    reason = (F.when(is_blank("question") | is_blank("query"), F.lit("skipped_empty"))
               .when(F.col("_avail").isNull(), F.lit("skipped_missing_db"))
               .otherwise(F.lit("converted")))
    q = with_schema(q.withColumn("reason", reason).drop("_avail"), corpus)
    record = F.struct(
        messages(("system", F.lit(system_prompt)),
                 ("user", F.concat(F.lit("Database Schema:\n"), F.col("schema"), F.lit("\n\nQuestion: "), F.col("question")))
                 ).alias("prompt"),
        F.lit(MTRL_ENV_CLASS).alias("env_class"),
        F.struct(F.col("query").alias("ground_truth"), F.lit(MTRL_STYLE).alias("style")).alias("reward_spec"),
        F.struct("db_id", "question", F.lit(MTRL_SPLIT).alias("split")).alias("extra_info"))
    return q.select(*source_order(q), "reason", "db_id", "question", "query", "schema", F.to_json(record).alias("prompt"))


def mtrl_convert(questions: DataFrame, available: DataFrame, corpus: DataFrame,
                 max_samples: int | None = None) -> DataFrame:
    kept = mtrl_tagged(questions, available, corpus).filter(F.col("reason") == "converted")
    if max_samples is not None:
        kept = first_n(kept, source_order(kept), max_samples)
    return kept
