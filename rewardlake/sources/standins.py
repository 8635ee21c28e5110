"""Reference-shaped tables derived from the driver's parquet tables.

The original datasets (coding problems, news articles, text-to-SQL pairs,
recorded agent episodes) are not available offline, so each is derived
deterministically from the given tables.  Every derivation is an ordinary
Spark projection / join / aggregation, so its work grows with the input.
Branch variety the source data lacks (fences, JSON, empty text) is
synthesised by fixed rules on the keys; whole tables and whole texts are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.jsonfns import messages
from ..functions.text import sentence_snap, py_strip
from ..operators.convert import SUMMARY_INSTRUCTION
from .readers import read_table, spread

# our own wording of the synthetic code prompts
CODE_PROMPT_LEAD = "Write a Python function for the task: "


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, article, highlights) from documents; both are the whole text."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select(F.col("doc_id").alias("ordinal"), F.col("text").alias("article"), F.col("text").alias("highlights"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, question, db_id, query) from documents (blank rows synthesised)."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select(
        F.col("doc_id").alias("ordinal"),
        F.when(F.col("doc_id") % 25 == 0, F.lit(" \t\n")).otherwise(F.col("text")).alias("question"),
        F.concat(F.lit("db_"), F.col("doc_id").cast("string")).alias("db_id"),
        F.when(F.col("doc_id") % 40 == 7, F.lit("  "))
         .otherwise(F.concat(F.lit("SELECT quality, toxic FROM labels WHERE doc_id = "), F.col("doc_id").cast("string")))
         .alias("query"))


def schema_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(db_id, schema_sql): one schema dump per labelled document.

    Dumps of low-quality rows hold no CREATE statement (PRAGMA/INSERT only),
    so the corpus filter drops them and the default schema text applies.
    """
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    k = F.col("doc_id").cast("string")
    create_main = F.concat(F.lit('CREATE TABLE "doc_'), k, F.lit('" (\n  "doc_id" int,\n  "quality" int,\n'
                                                                  '  PRIMARY KEY ("doc_id")\n);\n'))
    create_flag = F.concat(F.lit("create table flags_"), k, F.lit(" (\n  toxic int\n);\n"))
    body = F.concat(
        F.lit("PRAGMA foreign_keys = ON;\n"),
        F.when(F.col("quality") == 1, create_main).otherwise(F.lit("")),
        F.lit('INSERT INTO "doc_'), k, F.lit('" VALUES ('), k, F.lit(","), F.col("quality").cast("string"), F.lit(");\n"),
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), create_flag).otherwise(F.lit("")))
    return lab.select(F.concat(F.lit("db_"), k).alias("db_id"), body.alias("schema_sql"))


def available_dbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(db_id) keys that have a bundled database: the labelled documents."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id"])
    return lab.select(F.concat(F.lit("db_"), F.col("doc_id").cast("string")).alias("db_id"))


def code_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(problem_id, prompt, test_list) from part.

    Per part: a two-int call, a string+list call returning a tuple, a call
    with a structural mismatch (``set(f(..))``), a computed argument and a
    string/None/bool call returning a dict.  Some problems start with the
    mismatching test (name 'set', nothing parses) and some have no tests.
    """
    p = spread(read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]))
    fn = F.concat(F.lower("p_type"), F.lit("_"), F.regexp_replace("p_name", " ", "_"))
    size = F.col("p_size").cast("string")
    key = F.col("p_partkey").cast("string")
    brand = F.col("p_brand")
    t1 = F.concat(F.lit("assert "), fn, F.lit("("), size, F.lit(", "), key, F.lit(") == "),
                  (F.col("p_size") + F.col("p_partkey")).cast("string"))
    t2 = F.concat(F.lit("assert "), fn, F.lit("('"), brand, F.lit("', ["), size, F.lit(", 2]) == ("), size,
                  F.lit(", '"), brand, F.lit("')"))
    t3 = F.concat(F.lit("assert set("), fn, F.lit("("), size, F.lit(")) == set(["), size, F.lit("])"))
    t4 = F.concat(F.lit("assert "), fn, F.lit("("), size, F.lit(" ** 2) == "),
                  (F.col("p_size") * F.col("p_size")).cast("string"))
    t5 = F.concat(F.lit("assert "), fn, F.lit('("'), F.col("p_name"), F.lit('", None, True) == {"n": '), size,
                  F.lit("}"))
    tests = (F.when(F.col("p_partkey") % 13 == 5, F.array().cast("array<string>"))
              .when(F.col("p_partkey") % 9 == 4, F.array(t3, t1, t2))
              .otherwise(F.array(t1, t2, t3, t4, t5)))
    return p.select(F.col("p_partkey").alias("problem_id"),
                    F.concat(F.lit(CODE_PROMPT_LEAD), F.col("p_name"), F.lit(".")).alias("prompt"),
                    tests.alias("test_list"))


def test_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, test_idx, passed) from lineitem: every line reports the test
    of its line number (a line number that occurs twice is a re-delivery)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"])
    return li.select(F.col("l_orderkey").cast("string").alias("sample_id"),
                     (F.col("l_linenumber") - 1).cast("int").alias("test_idx"),
                     (F.col("l_returnflag") != F.lit("R")).alias("passed"))


def fenced_response(doc_id, text):
    """Deterministic model response around a document text (4 fence shapes,
    plus an empty response every 50th key)."""
    k = doc_id % 4
    return (F.when(doc_id % 50 == 49, F.lit(""))
             .when(k == 0, F.concat(F.lit("```python\n"), text, F.lit("\n```")))
             .when(k == 1, F.concat(F.lit("Answer:\n```\n"), text, F.lit("\n```\nDone.")))
             .when(k == 2, F.concat(F.lit("```python\n"), text))
             .otherwise(text))


def code_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RLVR scoring batch: one sample per order of ``lineitem`` and per document.

    The response is the document with the order's key or, where there is none,
    a function whose length follows from the key.  The ground truth has
    ``key % 8`` tests: a JSON list of assertions or, every third key, a JSON
    object with fn_name/inputs/outputs, in which every fifth such object begins
    with an integer input and every seventh repeats a key; every 13th key moves
    it to extra_info.reference_answer.text; every 17th is not JSON.
    """
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    orders = read_table(spark, sf_dir, "lineitem", ["l_orderkey"]).distinct()
    j = d.join(orders, d["doc_id"] == orders["l_orderkey"], "full")
    key = F.coalesce("doc_id", "l_orderkey")
    code = F.concat(F.lit("def f(x):\n"), F.repeat(F.lit("    x = x + 1\n"), (key % 40).cast("int")), F.lit("    return x"))
    j = j.select(key.alias("k"), F.coalesce("text", code).alias("text"))
    k, n = F.col("k"), (F.col("k") % 8).cast("int")
    each = lambda f, none: F.when(n == 0, F.array().cast(none)).otherwise(
        F.transform(F.sequence(F.lit(1), n), f))
    number = lambda i: i.cast("string")
    result = lambda i: (i * k).cast("string")
    fmt_a = F.to_json(each(lambda i: F.concat(F.lit("assert f("), number(i), F.lit(") == "), result(i)), "array<string>"))
    quoted = lambda f: F.array_join(each(lambda i: F.concat(F.lit('"'), f(i), F.lit('"')), "array<string>"), ",")
    inputs = F.when(k % 5 == 0, F.concat(F.lit("1"), F.when(n > 1, F.concat(F.lit(","), F.array_join(F.transform(
        F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda i: F.concat(F.lit('"'), number(i), F.lit('"'))), ","))).otherwise("")
        )).otherwise(quoted(number))
    fmt_b = F.concat(F.lit("{"), F.when(k % 7 == 0, F.lit('"fn_name":"g",')).otherwise(""), F.lit('"fn_name":"f","inputs":['),
                     inputs, F.lit('],"outputs":['), quoted(result), F.lit("]}"))
    gt = F.when(k % 17 == 0, F.lit("not json [")).when(k % 3 == 0, fmt_b).otherwise(fmt_a)
    in_ref = k % 13 == 0
    return j.select(
        k.cast("string").alias("id"),
        F.lit("mbpp").alias("data_source"),
        messages(("user", F.lit("Solve the task."))).alias("prompt"),
        fenced_response(k, F.col("text")).alias("response"),
        F.struct(F.lit("rule").alias("style"), F.when(in_ref, F.lit("")).otherwise(gt).alias("ground_truth")).alias("reward_model"),
        F.struct(F.struct(F.when(in_ref, gt).alias("text")).alias("reference_answer")).alias("extra_info"),
        k.alias("sample_ord"))


def judge_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RLAIF scoring batch: all documents, whole texts as response and
    reference; toxic rows give a blank response.  No judge has answered for a
    document without a label yet."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    j = d.join(lab, "doc_id", "left")
    article = sentence_snap(py_strip("text"))
    content = F.concat(F.lit(SUMMARY_INSTRUCTION), F.lit("\n\nArticle:\n"), article)
    return j.select(
        F.col("doc_id").cast("string").alias("id"),
        F.lit("cnn_dailymail").alias("data_source"),
        messages(("user", content)).alias("prompt"),
        F.when(F.col("toxic") == 1, F.lit("  ")).otherwise(F.col("text")).alias("response"),
        F.struct(F.lit("llmj").alias("style"), F.col("text").alias("ground_truth")).alias("reward_model"),
        F.col("doc_id").alias("sample_ord"), "quality", "toxic")


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, judge_text): five reply shapes by key; NULL = failed call.
    Every ninth sample's reply has not come yet; every fourth's came twice."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    k = F.col("doc_id") % 5
    q = F.col("quality").cast("string")
    txt = (F.when(k == 0, F.concat(F.lit('{"faithfulness": '), (F.col("quality") * 2 + 2).cast("string"),
                                    F.lit(', "coverage": 4, "no_redundancy": '), (5 - F.col("toxic") * 2).cast("string"),
                                    F.lit(', "appropriate_length": 2, "coherence": 5}')))
            .when(k == 1, F.concat(F.lit('Here is my rating:\n```json\n{"faithfulness": 5, "coverage": '),
                                   (F.col("quality") + 3).cast("string"),
                                   F.lit(', "no_redundancy": 4, "appropriate_length": 1, "coherence": 4}\n```')))
            .when(k == 2, F.concat(F.lit('{"faithfulness": 4, "coverage": '), q, F.lit("}")))
            .when(k == 3, F.lit("The summary looks fine to me.")))
    times = F.when(F.col("doc_id") % 9 == 4, 0).when(F.col("doc_id") % 4 == 1, 2).otherwise(1)
    return lab.select(F.col("doc_id").cast("string").alias("sample_id"), txt.alias("judge_text"),
                      F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded agent episodes (long form) from conversations.

    Assistant rows act by key: solution, empty text with a tool call, plain
    text (no action) or a ``<sql>`` tag.  User rows that follow an assistant
    row are observations; every 7th is an error.
    """
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    # role of the previous message: equi-join on (conv_id, turn) rather than a
    # window, so one very long conversation is not sorted in a single task
    prev = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("prev_role"))
    c = c.join(prev, ["conv_id", "turn"], "left")
    prev_role = F.col("prev_role")
    key = (F.col("conv_id") + F.col("turn"))
    sql = F.concat(F.lit("SELECT count(*) FROM t WHERE turn = "), F.col("turn").cast("string"))
    assistant = (F.when(key % 5 == 3, F.concat(F.col("text"), F.lit("\n<solution>SELECT "),
                                               F.col("conv_id").cast("string"), F.lit(" AS answer</solution>")))
                  .when(key % 5 == 1, F.lit(""))
                  .when(key % 5 == 4, F.col("text"))
                  .otherwise(F.concat(F.lit("<think>"), F.col("text"), F.lit("</think>\n<sql>"), sql, F.lit("</sql>"))))
    observation = F.concat(F.lit("<observation>\n"), F.when(key % 7 == 0, F.lit("Error: ")).otherwise(F.lit("")),
                           F.col("text"), F.lit("\n</observation>"))
    content = (F.when(F.col("role") == "assistant", assistant)
                .when((F.col("role") == "user") & (prev_role == "assistant"), observation)
                .otherwise(F.col("text")))
    args = (F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit('{"sql": "'), sql, F.lit('"}')))
             .when(F.col("conv_id") % 6 == 1, F.lit('{"sql": "  "}'))
             .when(F.col("conv_id") % 3 == 1, sql)
             .otherwise(F.concat(F.lit('{"limit": 5, "text": "'), sql, F.lit('"}'))))
    calls = F.when((F.col("role") == "assistant") & (key % 5 == 1),
                   F.array(F.struct(F.lit("execute_sql").alias("name"), args.alias("arguments"))))
    ts = (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("conv_id"), F.col("turn")))
    return c.select(F.col("conv_id").cast("string").alias("episode_id"), F.col("turn").cast("int").alias("turn"),
                    "role", content.alias("content"), calls.alias("tool_calls"), ts.alias("ts"))


def episodes_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode_id, db_id, gold_query, status, pred_status, pred_error, gold_status, db_present, db_path)."""
    c = read_table(spark, sf_dir, "conversations", ["conv_id"]).distinct()
    k = F.col("conv_id")
    return c.select(
        k.cast("string").alias("episode_id"),
        F.concat(F.lit("db_"), (k % 8).cast("string")).alias("db_id"),
        F.concat(F.lit("SELECT "), k.cast("string"), F.lit(" AS answer")).alias("gold_query"),
        F.when(k % 23 == 22, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.when(k % 11 == 10, F.lit("error")).otherwise(F.lit("ok")).alias("pred_status"),
        F.when(k % 23 == 22, F.lit("ValueError: no reply")).when(k % 11 == 10, F.lit("no such column: x")).alias("pred_error"),
        F.concat(F.lit("/db/db_"), (k % 8).cast("string"), F.lit(".sqlite")).alias("db_path"),
        F.when(k % 31 == 30, F.lit("error")).otherwise(F.lit("ok")).alias("gold_status"),
        (k % 8 != 7).alias("db_present"))


def result_rows(spark: SparkSession, sf_dir: str, pred_min: float = 50000.0) -> DataFrame:
    """Predicted and gold result rows per customer episode, from all orders.

    gold: (status, year as DOUBLE, price as DECIMAL, ratio and size as DOUBLE) of
    every order; pred: the same with the year as BIGINT, the ratio as
    DECIMAL(38,30) and the size, 1e25, as DECIMAL(38,0), which the comparison must
    ignore.  Every third customer's predicted query also asks for a price above
    ``pred_min``; every fifth's adds a hundred-millionth to prices that are far
    beyond a double's digits, every seventh's 1e-30 to the ratio and every
    eleventh's 1 to the size, which the comparison must not ignore.
    """
    from ..operators.resultset import to_cells
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    c = F.col("o_custkey")
    price = F.col("o_totalprice").cast("decimal(18,2)") + F.lit("9000000000000000").cast("decimal(18,0)")
    more = price + F.when(c % 5 == 0, F.lit("0.00000001").cast("decimal(9,8)")).otherwise(F.lit(0).cast("decimal(9,8)"))
    tenths = F.concat(F.lit("0."), (F.col("o_orderkey") % 10).cast("string"))
    tiny = F.concat(tenths, F.when(c % 7 == 0, F.lit("0" * 28 + "1")).otherwise(F.lit("")))
    o = o.select(c.cast("string").alias("episode_id"), F.col("o_orderkey").alias("row_no"), F.col("o_orderstatus").alias("status"),
                 F.year("o_orderdate").cast("bigint").alias("year"), price.cast(_PRICE).alias("price"), more.cast(_PRICE).alias("more"),
                 tenths.cast("double").alias("ratio"), tiny.cast(_RATIO).alias("exact_ratio"),
                 F.when(c % 11 == 0, F.lit("1" + "0" * 24 + "1")).otherwise(F.lit("1" + "0" * 25)).cast(_SIZE).alias("exact_size"),
                 F.lit(1e25).alias("size"), ((c % 3 != 0) | (F.col("o_totalprice") > pred_min)).alias("asked"))
    # one scan of orders feeds both sides
    sides = o.withColumn("side", F.explode(F.when(F.col("asked"), F.array(F.lit("pred"), F.lit("gold"))).otherwise(F.array(F.lit("gold")))))
    return sides.withColumn("cells", F.when(F.col("side") == "pred", to_cells(*_result_values("pred")))
                            .otherwise(to_cells(*_result_values("gold"))))


_PRICE, _RATIO, _SIZE = T.DecimalType(38, 8), T.DecimalType(38, 30), T.DecimalType(38, 0)


def _result_values(side: str) -> list:
    """The values of a side's rows, with their types."""
    if side == "pred":
        typed = [("status", T.StringType()), ("year", T.LongType()), ("more", _PRICE), ("exact_ratio", _RATIO), ("exact_size", _SIZE)]
    else:
        typed = [("status", T.StringType()), ("year", T.DoubleType()), ("price", _PRICE), ("ratio", T.DoubleType()), ("size", T.DoubleType())]
    return [(F.col(c).cast(t), t) for c, t in typed]


def result_texts():
    """The texts of the values of ``result_rows``, as its preview shows them."""
    from ..operators.resultset import shown
    texts = {side: F.array(*(shown(*t) for t in _result_values(side))) for side in ("pred", "gold")}
    return F.when(F.col("side") == "pred", texts["pred"]).otherwise(texts["gold"])


def customer_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read_table(spark, sf_dir, "customer", ["c_custkey"])
    return cu.select(F.col("c_custkey").cast("string").alias("episode_id"))


def tool_call_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(call_id, arguments) in six shapes by part key."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    sql = F.concat(F.lit("SELECT * FROM part WHERE p_partkey = "), F.col("p_partkey").cast("string"))
    k = F.col("p_partkey") % 6
    args = (F.when(k == 0, F.concat(F.lit("  "), sql, F.lit(" ")))
             .when(k == 1, F.concat(F.lit('{"sql": " '), sql, F.lit('"}')))
             .when(k == 2, F.concat(F.lit('{"query": "'), sql, F.lit('", "sql": "SELECT 1"}')))
             .when(k == 3, F.concat(F.lit('{"limit": 5, "note": "'), F.col("p_name"), F.lit('", "text": "'), sql, F.lit('"}')))
             .when(k == 4, F.concat(F.lit('"'), sql, F.lit('"')))
             .otherwise(F.lit("[1, 2]")))
    return p.select(F.col("p_partkey").alias("call_id"), args.alias("arguments"))
