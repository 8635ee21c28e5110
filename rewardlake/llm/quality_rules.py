"""Operator 10: quality rules with thresholds learnt from quantile sketches.

Every text gets its statistics once, in one pass.  For each language and
source Spark builds mergeable quantile sketches of the ratios (partial
sketches in each task, merged after the shuffle); a ratio beyond the group's
fence rejects a document.  A fence's distance from the group's median is the
larger of two, neither of which a bad minority can move:

* ``SPREAD`` times the distance of the nearer quartile: as long as under half of
  a group is bad, on whichever side, neither the median nor both quartiles are
  bad values;
* half-way from the 99th percentile of the group's ordinary distances beyond
  the median to the ratio's bound, from a second sketch; ordinary are those
  within the bound.  Most ratios are 0 in most documents, where the first says
  nothing; this one follows what the group's other documents do, and what lies
  beyond the bound neither moves it nor passes it.

Only a group in which no value differs from the median within the bound takes
the bound itself.  Fences of small groups lean on those of their language, and
these on the corpus', in proportion: ``n`` documents of a group count against
``LEAN`` of what it belongs to.

Defined results: a null or empty text has no words, so it fails the base rule;
null language or source forms a group of its own; a null ``doc_id`` stays
null; repeated rows are each judged; an empty table gives no row; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_documents

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
#: Ratio: distance from the median up to which values may be ordinary.  Only an upper fence, but for word length.
RATIOS = {"symbol_ratio": 0.05, "dup_line_ratio": 0.35, "repeat_ratio": 0.35, "upper_ratio": 0.2, "word_length": 2.0}
LOW = {"word_length": 1.5}
#: ``SPREAD`` quartile distances of a normal distribution are 5.1 standard deviations.
SPREAD, LEAN, ACCURACY = 7.6, 200, 10_000
#: Most groups whose thresholds are broadcast (about 100 bytes each); more are joined by shuffle.
MOST_BROADCAST = 20_000

_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def text_stats(text: str) -> tuple[int, ...]:
    """The counts named in ``_STATS``."""
    words = text.encode().split()
    word_chars = len(text) - sum(map(text.count, _BLANKS))
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)] if "\n" in text else [text] * bool(words)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, covered = Counter(windows), -1  # covered: last word counted
        for i, window in enumerate(windows):
            if times[window] > 1:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    upper = sum(map(str.isupper, text))
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines), upper


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts and the ratios of every row."""
    names = ["doc_id", "lang", "source", *_STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [text_stats(t.as_py()) for t in batch.column(3)]
            columns = zip(*stats, strict=True) if stats else [()] * len(_STATS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(3)] + [pa.array(c, pa.int64()) for c in columns], names=names)

    over = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("lang"),
                       docs["source"].cast("string").alias("source"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _STATS)) \
        .select("*", over("n_symbols", "word_chars").alias("symbol_ratio"),
                over("n_dup_lines", "n_lines").alias("dup_line_ratio"),
                over("n_repeat_words", "n_words").alias("repeat_ratio"),
                over("n_upper", "word_chars").alias("upper_ratio"),
                over("word_chars", "n_words").alias("word_length"))


def _levels(stats: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns``, aggregated for each language and source, language, and all, told apart by ``level`` 0, 1, 3."""
    return stats.rollup("lang", "source").agg(F.grouping_id().alias("level"), *columns)


def _fences() -> list[tuple[str, str, float, int]]:
    return [(f"high_{r}", r, bound, 1) for r, bound in RATIOS.items()] + [(f"low_{r}", r, bound, -1) for r, bound in LOW.items()]


def thresholds(stats: DataFrame) -> DataFrame:
    """One row a language and source with its fences, ``high_<ratio>`` and ``low_<ratio>``."""
    stats = stats.filter("n_words > 0")
    thirds = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    first = materialize(stats.sparkSession, _levels(stats, [
        F.count("*").alias("n"), *(F.percentile_approx(r, thirds, F.lit(ACCURACY)).alias(r) for r in RATIOS)]), "quality-quartiles")
    whole = first.filter("level = 3").first()  # one row
    if whole is None or not whole["n"]:
        return first.select("lang", "source", *(F.lit(None).cast("double").alias(f) for f, *_ in _fences())).limit(0)

    def of_level(level: int, name: str) -> DataFrame:
        keys = ["lang", "source"][:2 - level]
        return first.filter(F.col("level") == level).select(*(F.col(k).alias(f"{name}_{k}") for k in keys), F.struct("n", *RATIOS).alias(name))

    def with_quartiles(rows: DataFrame) -> DataFrame:
        own, lang = (_bounded(of_level(*x)) for x in ((0, "own"), (1, "of_lang")))
        rows = rows.join(own, rows["lang"].eqNullSafe(own["own_lang"]) & rows["source"].eqNullSafe(own["own_source"]), "left")
        rows = rows.join(lang, rows["lang"].eqNullSafe(lang["of_lang_lang"]), "left")
        of_all = F.struct(F.lit(whole["n"]).alias("n"), *(F.lit([float(x) for x in whole[r]]).alias(r) for r in RATIOS))
        return rows.withColumn("of_all", of_all)

    # the second sketch: ordinary distances beyond the median of each level
    names = ("own", "of_lang", "of_all")
    beyond = {}
    for fence, ratio, bound, sign in _fences():
        for name in names:
            away = sign * (F.col(ratio) - F.col(name)[ratio][1])
            beyond[f"{name}_{fence}"] = F.percentile_approx(F.when((away > 0) & (away <= bound), away), F.lit(0.99), F.lit(ACCURACY))
    second = materialize(stats.sparkSession, _levels(with_quartiles(stats), [v.alias(k) for k, v in beyond.items()]), "quality-distances")
    reach = {level: second.filter(F.col("level") == level) for level in (0, 1, 3)}
    groups = with_quartiles(first.filter("level = 0").select("lang", "source"))
    own = reach[0].select(F.col("lang").alias("_l"), F.col("source").alias("_s"), *(f"own_{f}" for f, *_ in _fences()))
    lang = reach[1].select(F.col("lang").alias("_ll"), *(f"of_lang_{f}" for f, *_ in _fences()))
    over_all = reach[3].first()
    groups = groups.join(_bounded(own), groups["lang"].eqNullSafe(F.col("_l")) & groups["source"].eqNullSafe(F.col("_s")), "left")
    groups = groups.join(_bounded(lang), groups["lang"].eqNullSafe(F.col("_ll")), "left")

    def fence(name: str, ratio: str, bound: float, sign: int) -> Column:
        def at(level: str) -> Column:
            low, middle, high = (F.col(level)[ratio][i] for i in range(3))
            far = F.lit(over_all[f"of_all_{name}"]).cast("double") if level == "of_all" else F.col(f"{level}_{name}")
            return middle + sign * F.greatest(SPREAD * F.least(middle - low, high - middle), (F.coalesce(far, F.lit(bound)) + bound) / 2)
        lang_n, own_n = F.col("of_lang")["n"], F.col("own")["n"]
        of_lang = (lang_n * at("of_lang") + LEAN * at("of_all")) / (lang_n + LEAN)
        return (own_n * at("own") + LEAN * of_lang) / (own_n + LEAN)

    return groups.select("lang", "source", *(fence(*f).alias(f[0]) for f in _fences()))


def _bounded(groups: DataFrame) -> DataFrame:
    """``groups`` with a hint to broadcast them if they are few."""
    return F.broadcast(groups) if groups.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else groups


def judge(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """``stats`` plus ``base_failed`` and ``kept``."""
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                           *(c for c in limits.columns if c not in ("lang", "source")))
    limits = _bounded(limits)
    on = stats["lang"].eqNullSafe(limits["_lang"]) & stats["source"].eqNullSafe(limits["_source"])
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = F.lit(True)
    for r in RATIOS:
        fine &= F.coalesce(F.col(r) <= F.col(f"high_{r}"), F.lit(True))
    for r in LOW:
        fine &= F.coalesce(F.col(r) >= F.col(f"low_{r}"), F.lit(True))
    return stats.join(limits, on, "left").select(*stats.columns, base.alias("base_failed"), (~base & fine).alias("kept"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(spark, measure(read_documents(spark, sf_dir)), "quality-stats")
    limits = materialize(spark, thresholds(stats), "quality-limits")
    return judge(stats, limits).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                       "base_failed", "kept")
