"""Operator 12: what each of a few filters removes, alone and in every order, by potentials of the removal game.

A document's failures are a bit mask.  A coalition of filters is worth the
documents that fail any of its filters; per part of the corpus these are sums
over at most ``2^n`` mask counts, which is all that leaves the documents.  On
those, DataFrame expressions compute

* the Hart-Mas-Colell potential of each coalition S from those of S without one
  filter: ``|S| P(S) = v(S) + sum of P(S - i)``.  It is kept times ``n!``, where
  all are whole numbers; a filter's Shapley value is the potential of all
  filters minus that of all but it, so times ``n!`` it is the filter's removals
  summed over all orders;
* every step of every order from differences of coalition values: what a filter
  removes after the filters S is ``v(S + i) - v(S)``.

Copies are found by hash of the text: rows are counted by text, part and label
before texts meet, so a text that a third of the rows hold is a few rows there.

Defined results: a null text is an empty one and a null source the part ``''``;
a row with a null ``doc_id`` has no smaller one and is none, so it never fails
as a copy; rows with the same id and text are no copies of each other; labels
given more than once count if any row says so; labels without a document are
ignored; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_documents

BLANKS = r"[\x20\x09-\x0D]+"

# ---- fixed values: the filters of the query ----
LETTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT, MOST_UPPER = 65, 5  # per cent
SYMBOLS = r"[#$%&*|]"
# ------------------------------------------------


def text_failures(text: Column) -> Column:
    """Bits of filters A to D for a text that is not null."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < LEAST_WORDS, F.lit(100).cast("long") * distinct < F.lit(LEAST_DISTINCT).cast("long") * n,
             F.lit(100).cast("long") * upper > F.lit(MOST_UPPER).cast("long") * F.length(text), text.rlike(SYMBOLS)]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters that they fail."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["source"], F.lit("")).alias("part"),
                       text_failures(text).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("name"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    keys = ["name", "part", "mask", "good", "toxic"]
    # rows with one id and text count together; then each text, part and label is one row, with its least id
    by_id = rows.groupBy("doc_id", *keys).agg(F.count("*").alias("n"))
    by_text = by_id.groupBy(*keys, F.col("doc_id").isNull().alias("nameless")).agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("name"))
    copies = F.when(F.col("nameless"), F.lit(0)).when(F.col("first.doc_id") == least, F.col("n") - F.col("first.n")).otherwise(F.col("n"))
    split = by_text.select("part", "mask", "good", "toxic", "n", copies.alias("copies"))
    copy_bit = 1 << LETTERS.index("E")
    split = split.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", (F.col("n") - F.col("copies")).alias("n")),
        F.struct(F.col("mask").bitwiseOR(copy_bit).alias("mask"), F.col("copies").alias("n")))).alias("of"))
    n = F.col("of.n")
    return split.filter(n > 0).groupBy("part", F.col("of.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(F.lit(0))).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(F.lit(0))).alias("toxic"))


def coalition_values(entries: Column, field: str, filters: int) -> Column:
    """v(S) for S from 0: the sum of ``field`` over the masks that share a filter with S."""
    return F.transform(F.sequence(F.lit(0), F.lit((1 << filters) - 1)), lambda s: F.aggregate(
        entries, F.lit(0).cast("long"),
        lambda total, e: total + F.when(e["mask"].bitwiseAND(s) != 0, e[field]).otherwise(F.lit(0).cast("long"))))


def potentials(values: Column, filters: int) -> Column:
    """``filters!`` times the potential of every coalition, each from those with one filter less."""
    def of(known: Column, s: Column) -> Column:
        without = sum((F.when(s.bitwiseAND(1 << i) != 0, F.get(known, s.bitwiseXOR(F.lit(1 << i)))).otherwise(F.lit(0).cast("long"))
                       for i in range(filters)), F.lit(0).cast("long"))
        total = F.lit(factorial(filters)).cast("long") * F.get(values, s) + without
        return F.call_function("div", total, F.bit_count(s).cast("long"))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(F.lit(0).cast("long")),
                       lambda known, s: F.concat(known, F.array(of(known, s))))


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every step of every order of the filters, per part of ``counts`` (part, mask, n, good, toxic); bit i of
    a mask is the filter ``letters[i]``."""
    k, every = len(letters), (1 << len(letters)) - 1
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("entries"))
    parts = parts.select("part", F.aggregate("entries", F.lit(0).cast("long"), lambda t, e: t + e["n"]).alias("total"),
                         *(coalition_values(F.col("entries"), c, k).alias(f"v_{c}") for c in ("n", "good", "toxic")))
    parts = parts.withColumn("potential", potentials(F.col("v_n"), k))
    orders = ",".join("".join(p) for p in permutations(letters))
    steps = parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    bits = F.transform(F.split("filter_order", ""), lambda x: sum(
        (F.when(x == c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(letters)), F.lit(0)))
    steps = steps.withColumn("bits", bits).withColumn("before", F.aggregate(
        F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda a, b: a + b)).withColumn("bit", F.get("bits", F.col("step") - 1))
    after, rest = F.col("before") + F.col("bit"), F.lit(every) - F.col("bit")

    def lost(c: str) -> Column:
        return F.get(f"v_{c}", after) - F.get(f"v_{c}", F.col("before"))

    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.get("v_n", after)).alias("kept"), lost("n").alias("removed"),
        (F.get("v_n", F.col("bit")) - lost("n")).alias("redundant"),
        (F.get("v_n", F.lit(every)) - F.get("v_n", rest)).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(every)) - F.get("potential", rest)).alias("shapley"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mask_counts(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "labels")))


#: The same from the definitions: every order is applied, and removals are summed over all orders.
OP12_SQL = r"""
WITH marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(words) < 50,
    100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t),
    regexp_matches(t, '[#$%&*|]'),
    coalesce(texts.doc_id > first_id, false)] AS f
  FROM texts LEFT JOIN marks USING (doc_id)
), counts AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY part, f
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.i NOT IN (b.i, c.i, d.i, e.i) AND b.i NOT IN (c.i, d.i, e.i) AND c.i NOT IN (d.i, e.i) AND d.i <> e.i
), steps AS (SELECT filter_order, o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
applied AS (
  SELECT part, filter_order, step, o[step] AS i, f, n, good, toxic, f[o[step]] AS failing,
         coalesce(list_bool_or(list_transform(o[1:step - 1], lambda x: f[x])), false) AS gone,
         list_sum(list_transform(f, lambda x: x::INT)) = 1 AS alone
  FROM steps, counts
), per_step AS (
  SELECT part, filter_order, step, i, coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS removed, coalesce(sum(n) FILTER (gone AND failing), 0) AS redundant,
         coalesce(sum(n) FILTER (failing AND alone), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND failing), 0) AS toxic_lost
  FROM applied GROUP BY part, filter_order, step, i
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, i))::BIGINT AS shapley
FROM per_step
"""
