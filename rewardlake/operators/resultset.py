"""Result-set equality between predicted and gold query results (§2.11).

Semantics kept from the reference's ``set(rows) == set(rows)``: columns are
positional (names ignored), duplicates and order are ignored, NULL equals
NULL, 1 = 1.0 = True, text never equals a number, and two empty results are
equal.  Numbers of any type are compared exactly: a double counts as the
shortest decimal that names it, so 0.1 and DECIMAL 0.1 are one number and
0.1 and DECIMAL 0.100000000000000000000000000001 are two.

Each cell is made canonical by decimal arithmetic, without text: a whole number
that fits a bigint is ``i``; any other with at most 38 digits on either side of
the point is its floor ``w`` and the rest ``f``, at fixed scales; a double
beyond that, which no decimal can equal, is ``n``.  There is no floating-point
field, so a row, the ARRAY of its cells, is grouped by its bytes as it is.

Plan: two aggregations with partial (map-side) combine -- first on
(episode_id, cells), whose hash spreads even one huge episode over all tasks,
then on episode_id, which receives one partial row per task and episode.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .topk import first_k_per_group

CELL = "struct<i:bigint,s:string,w:decimal(38,0),f:decimal(38,38),n:string>"

# ---- fixed values: result observation formats ----
PREVIEW_ROWS = 20
RESULT_HEADER = "Result ({n} rows):\n"
RESULT_ROW = "  {row}\n"
RESULT_MORE = "  ... ({k} more rows)\n"
NO_ROWS_TEXT = "Query executed successfully. No rows returned."
ERROR_TEXT = "Error: {error}"
# ---------------------------------------------------


_WHOLE, _PART = "decimal(38,0)", "decimal(38,38)"
_ZERO = Decimal(0)


def _cell(i=None, s=None, w=None, f=None, n=None) -> Column:
    values = {"i": (i, "bigint"), "s": (s, "string"), "w": (w, _WHOLE), "f": (f, _PART), "n": (n, "string")}
    return F.struct(*((v if v is not None else F.lit(None)).cast(t).alias(k) for k, (v, t) in values.items()))


def _double_cell(d: Column) -> Column:
    # no cast below can overflow where it is used: a failing cast costs more than all the rest
    size, plain, part = F.abs(d), d.cast("decimal(38,20)"), d.cast(_PART)
    integral = d == F.rint(d)
    return (F.when(integral & (size < F.lit(9.2e18)), _cell(i=d.cast("bigint")))
             .when(integral & (size < F.lit(9e37)), _cell(w=d.cast(_WHOLE), f=F.lit(_ZERO)))
             .when(~integral & (size >= 1) & (size < F.lit(9.2e18)), _cell(w=F.floor(plain), f=plain % 1))
             .when((size < 1) & F.when(size < 1, part.cast("double") == d),
                   _cell(w=F.when(d < 0, F.lit(-1)).otherwise(F.lit(0)), f=part))
             .otherwise(_cell(n=d.cast("string"))))


def _decimal_cell(c: Column, dtype: T.DecimalType) -> Column:
    digits, scale = dtype.precision - dtype.scale, dtype.scale
    whole, rest, fits = c, F.lit(_ZERO), F.lit(True)
    if scale:
        whole, rest = F.floor(c), c % 1
        fits = rest == F.lit(_ZERO).cast(T.DecimalType(min(digits, 1) + scale, scale))
    if digits > 18:
        low, high = (F.lit(Decimal(v)).cast(dtype) for v in (-(1 << 63), (1 << 63) - 1))
        fits = c.between(low, high) & fits
    return F.when(fits, _cell(i=whole.cast("bigint"))).otherwise(_cell(w=whole, f=rest))


def cell(c: Column, dtype: T.DataType) -> Column:
    """Canonical cell of a typed value."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        value = _cell(i=c)
    elif isinstance(dtype, T.BooleanType):
        value = _cell(i=c.cast("int"))
    elif isinstance(dtype, T.DecimalType):
        value = _decimal_cell(c, dtype)
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        value = _double_cell(c.cast("double"))
    else:
        value = _cell(s=c.cast("string"))
    return F.when(c.isNull(), _cell()).otherwise(value)


def to_cells(*typed: tuple[Column, T.DataType]) -> Column:
    """Row of canonical cells from ``(column, type)`` pairs."""
    return F.array(*(cell(*c) for c in typed))


def frame_cells(df: DataFrame) -> DataFrame:
    """A live DataFrame's rows as canonical cell arrays (schema-driven)."""
    return df.select(F.array(*[cell(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]).alias("cells"))


def distinct_rows(results: DataFrame) -> DataFrame:
    """Step 2: one row per (episode_id, cells) with the sides it occurs on."""
    return results.groupBy("episode_id", "cells").agg(
        F.bool_or(F.col("side") == "pred").alias("p"), F.bool_or(F.col("side") == "gold").alias("g"))


def set_equality(results: DataFrame) -> DataFrame:
    """(episode_id, sets_equal, pred_only, gold_only) for episodes with rows."""
    d = distinct_rows(results)
    return d.groupBy("episode_id").agg(
        F.bool_and(F.col("p") & F.col("g")).alias("sets_equal"),
        F.count_if(F.col("p") & ~F.col("g")).alias("pred_only"),
        F.count_if(F.col("g") & ~F.col("p")).alias("gold_only"))


def result_set_rewards(episodes: DataFrame, results: DataFrame) -> DataFrame:
    """SET2 / JOIN5 for many episodes: ``episodes(episode_id)`` and
    ``results(episode_id, side, row_no, cells)``; both-empty -> equal."""
    eq = set_equality(results)
    j = episodes.select("episode_id").join(eq, "episode_id", "left")
    equal = F.coalesce(F.col("sets_equal"), F.lit(True))
    return j.select("episode_id", equal.alias("sets_equal"),
                    F.coalesce("pred_only", F.lit(0)).alias("pred_only"),
                    F.coalesce("gold_only", F.lit(0)).alias("gold_only"),
                    F.when(equal, F.lit(1.0)).otherwise(F.lit(0.0)).alias("reward"))


def frames_match(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """Set equality of two live DataFrames -> one row ``(sets_equal)``."""
    rows = frame_cells(pred).withColumn("side", F.lit("pred")).unionByName(
        frame_cells(gold).withColumn("side", F.lit("gold"))).withColumn("episode_id", F.lit("frame"))
    eq = set_equality(rows)
    base = pred.sparkSession.range(1).select(F.lit("frame").alias("episode_id"))
    return base.join(eq, "episode_id", "left").select(F.coalesce("sets_equal", F.lit(True)).alias("sets_equal"))


def result_set_diff(results: DataFrame) -> DataFrame:
    """SET3: the distinct rows found on one side only."""
    d = distinct_rows(results).filter(F.col("p") != F.col("g"))
    return d.select("episode_id", F.when(F.col("p"), F.lit("pred")).otherwise(F.lit("gold")).alias("only_in"), "cells")


def shown(c: Column, dtype: T.DataType) -> Column:
    """Python-like text of a typed value; a float keeps its decimal point."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        d = c.cast("double")
        digits = F.rtrim(d.try_cast("decimal(38,22)").cast("string"), F.lit("0"))
        plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
        text = d.cast("string")  # 1.5E25, 1.0E-7
        power = F.substring_index(text, "E", -1).try_cast("int")
        scaled = F.concat(F.replace(F.concat(F.substring_index(text, "E", 1), F.lit("|")), F.lit(".0|"), F.lit("|")),
                          F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
                          F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"))
        value = F.when((d == 0) | F.abs(d).between(1e-4, 9999999999999998.0), plain) \
                 .when(power.isNotNull(), F.replace(scaled, F.lit("|"), F.lit(""))).otherwise(F.lower(text))
    elif isinstance(dtype, T.StringType):
        value = F.concat(F.lit("'"), c, F.lit("'"))
    elif isinstance(dtype, T.BooleanType):
        value = F.initcap(c.cast("string"))
    else:
        value = c.cast("string")
    return F.coalesce(value, F.lit("None"))


def number_text(c: Column) -> Column:
    """Plain digits of a canonical cell's number; NULL if it holds none."""
    w, f = c["w"], c["f"]
    zero = F.lit(_ZERO).cast(_PART)
    whole = F.abs(F.when(f < zero, w + 1).otherwise(w)).cast(_WHOLE).cast("string")
    rest = F.rtrim(F.substring_index(F.abs(f).cast("string"), ".", -1), F.lit("0"))
    exact = F.concat(F.when(w < 0, F.lit("-")).otherwise(F.lit("")), whole,
                     F.when(f == zero, F.lit("")).otherwise(F.concat(F.lit("."), rest)))
    return F.coalesce(c["i"].cast("string"), exact, c["n"])


def cell_text(c: Column) -> Column:
    """Python-like text of a canonical cell, which no longer tells 1.0 from 1."""
    return F.coalesce(number_text(c), F.concat(F.lit("'"), c["s"], F.lit("'")), F.lit("None"))


def row_text(texts: Column) -> Column:
    """A row of value texts as a tuple."""
    return F.concat(F.lit("("), F.array_join(texts, ", "), F.when(F.size(texts) == 1, F.lit(",)")).otherwise(F.lit(")")))


def _fill(template: str, **cols: Column) -> Column:
    """One ``{name}`` slot of a fixed format filled with a string column."""
    (name, col), = cols.items()
    head, tail = template.split("{" + name + "}")
    return F.concat(F.lit(head), col, F.lit(tail))


def result_preview(results: DataFrame, rows: int = PREVIEW_ROWS, episodes: DataFrame | None = None,
                   texts: Column | None = None) -> DataFrame:
    """LIM2 + FN23: per (episode_id, side) the observation text of a result:
    ``Result (n rows):`` + the first ``rows`` rows (by row_no) + the
    ``... (k more rows)`` line.  Counts use a partial aggregation and the
    first rows a map-side top-k, so a huge result never lands in one task.
    ``texts``, the values' texts as an array over the columns of ``results``
    (else those of the cells), is computed for the first rows only.

    With ``episodes`` every (episode, side) gets a row; an empty result gives
    the no-rows text and ``n_rows = 0``."""
    keys = ["episode_id", "side"]
    counts = results.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    top = first_k_per_group(results, keys, ["row_no"], rows, "rn")
    top = top.select(*keys, "rn", (F.transform("cells", cell_text) if texts is None else texts).alias("texts"))
    lines = top.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("rn", _fill(RESULT_ROW, row=row_text(F.col("texts"))).alias("line"))))
        .alias("lines"))
    j = counts.join(lines, keys)
    more = F.when(F.col("n_rows") > rows, _fill(RESULT_MORE, k=(F.col("n_rows") - rows).cast("string"))) \
            .otherwise(F.lit(""))
    text = F.concat(_fill(RESULT_HEADER, n=F.col("n_rows").cast("string")),
                    F.array_join(F.transform("lines", lambda x: x["line"]), ""), more)
    out = j.select(*keys, "n_rows", text.alias("preview"))
    if episodes is None:
        return out
    sides = episodes.select("episode_id", F.explode(F.array(F.lit("pred"), F.lit("gold"))).alias("side"))
    full = sides.join(out, keys, "left")
    return full.select(*keys, F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                       F.coalesce("preview", F.lit(NO_ROWS_TEXT)).alias("preview"))



def execution_observation(previews: DataFrame, executions: DataFrame) -> DataFrame:
    """FN23 complete: the observation text of each executed query.

    ``executions(episode_id, side, status, error)``: a failed execution gives
    ``Error: <message>``; otherwise the preview (or the no-rows text)."""
    keys = ["episode_id", "side"]
    j = executions.join(previews.select(*keys, "preview"), keys, "left")
    text = F.when(F.col("status") == "error", _fill(ERROR_TEXT, error=F.coalesce("error", F.lit("")))) \
            .otherwise(F.coalesce("preview", F.lit(NO_ROWS_TEXT)))
    return j.select(*keys, text.alias("observation"))
