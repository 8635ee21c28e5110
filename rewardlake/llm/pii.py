"""Operator 1: personal data, in DataFrame functions only.

Regular expressions propose spans; checksums (Luhn for cards, mod 97 for bank
accounts) and range checks confirm them; words near a span raise or lower its
score.  A span of a base kind stays whatever its score; one of an added kind
(``iban``, ``ssn``) needs ``KEEP``.

The patterns are possessive, so no text makes them backtrack.  A run that
fails is not tried again from its middle (the look-behinds), except where the
last match ended (``\\G``), which keeps the leftmost non-overlapping reading.
Offsets come from the pieces between the matches and count code points.

Defined results: a null or empty text has no spans; a null ``doc_id`` stays
null; repeated rows are each reported; an empty table gives no row; other
columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, read_documents

#: Characters on either side of a span in which context words count.
NEAR = 40
#: Least score of a span of an added kind.
KEEP = 0.6
RAISE, LOWER = 0.3, 0.3


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a literal or, with a leading "~", a pattern that any text with a match contains
    prior: float
    context: str
    base: bool = True


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         "mail|contact|write|reach"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "~[0-9]\\.[0-9]", 0.6, "ip|address|host|server|login"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+", "~[0-9][0-9 -]{10}", 0.9,
         "card|visa|credit|payment|pay"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.7, "call|phone|tel|mobile|contact"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9])",
         "~[A-Z]{2}[0-9]{2}[ A-Z0-9]", 0.9, "iban|account|bank|konto|cuenta|compte", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "~[0-9]-[0-9]", 0.4,
         "ssn|social|security|taxpayer", base=False),
)
UNLIKELY = "version|release|build|example|isbn|order|invoice"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number's letters and digits, its first four at the end, leave 1 modulo 97."""
    a = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(a, F.lit(5), F.length(a)), F.substring(a, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        value = F.when(c < "A", c.cast("int")).otherwise(F.ascii(c) - 55)
        return (acc * F.when(value > 9, 100).otherwise(10) + value) % 97
    return F.aggregate(F.split(moved, "(?<=.)(?=.)"), F.lit(0), step) == 1


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(
            "^([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        d = _digits(match)
        return F.length(d).between(12, 19) & luhn(d)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def find_spans(df: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``df`` plus ``pii``: array of (start, kind_no, end, score), by start, then kind."""
    t, own = F.col(text), df.columns
    hit = lambda k: t.rlike(k.hint[1:]) if k.hint[0] == "~" else t.contains(k.hint)
    df = df.select("*", *(F.when(hit(k), F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))).alias(f"_m_{k.name}")
                          for k in kinds))

    def between(k: Kind) -> Column:
        return F.when(F.size(f"_m_{k.name}") > 0, F.transform(F.split(t, k.pattern, -1), lambda g: F.struct(
            F.length(g).alias("n"), F.lower(F.right(g, F.lit(NEAR))).alias("before"),
            F.lower(F.left(g, F.lit(NEAR))).alias("after"))))
    df = df.select("*", *(between(k).alias(f"_g_{k.name}") for k in kinds))

    # a match ends where all gaps and matches so far end: sums over whole blocks of about the root of
    # their number, and over the own block; nothing grows match by match
    def blocks(k: Kind) -> Column:
        m, g = F.col(f"_m_{k.name}"), F.col(f"_g_{k.name}")
        size = F.ceil(F.sqrt(F.size(m))).cast("int")
        steps = F.zip_with(F.slice(g, F.lit(1), F.size(m)), m, lambda gap, match: gap["n"] + F.length(match))
        return F.when(F.size(m) > 0, F.transform(F.sequence(F.lit(0), F.ceil(F.size(m) / size).cast("int") - 1),
                                                 lambda b: F.slice(steps, b * size + 1, size)))
    df = df.select(*own, *(F.col(f"_{c}_{k.name}") for k in kinds for c in "mg"), *(blocks(k).alias(f"_b_{k.name}") for k in kinds))

    def total(steps: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)
    df = df.select("*", *(F.transform(f"_b_{k.name}", total).alias(f"_t_{k.name}") for k in kinds))

    def ends(k: Kind) -> Column:
        sums = F.col(f"_t_{k.name}")
        begins = F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))
        return F.flatten(F.transform(F.arrays_zip(begins.alias("at"), F.col(f"_b_{k.name}").alias("steps")), lambda b: F.transform(
            b["steps"], lambda _, i: b["at"] + total(F.slice(b["steps"], F.lit(1), i + 1)))))
    df = df.select("*", *(ends(k).alias(f"_e_{k.name}") for k in kinds))

    def located(k: Kind) -> Column:
        """Every match with its place and the texts around it."""
        m, g = F.col(f"_m_{k.name}"), F.col(f"_g_{k.name}")
        return F.transform(f"_e_{k.name}", lambda end, i: F.struct(
            (end - F.length(F.get(m, i))).alias("start"), end.alias("end"), F.get(m, i).alias("match"),
            F.get(g, i)["before"].alias("before"), F.get(g, i + 1)["after"].alias("after")))
    df = df.select(*own, *(located(k).alias(f"_l_{k.name}") for k in kinds))

    def scored(no: int, k: Kind) -> Column:
        near = lambda s, words: (s["before"].rlike(words) | s["after"].rlike(words)).cast("int")
        spans = F.transform(F.filter(F.col(f"_l_{k.name}"), lambda s: valid(k.name, s["match"])), lambda s: F.struct(
            s["start"].alias("start"), F.lit(no).alias("kind_no"), s["end"].alias("end"),
            F.round(F.least(F.lit(1.0), F.lit(k.prior) + near(s, k.context) * RAISE - near(s, UNLIKELY) * LOWER), 2)
            .alias("score")))
        spans = spans if k.base else F.filter(spans, lambda s: s["score"] >= KEEP)
        return F.coalesce(spans, F.array().cast("array<struct<start:int,kind_no:int,end:int,score:double>>"))
    return df.select(*own, F.sort_array(F.concat(*(scored(i, k) for i, k in enumerate(kinds)))).alias("pii"))


def span_text(spans: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*(F.lit(k.name) for k in kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = find_spans(id_and_text(read_documents(spark, sf_dir))).select("doc_id", "pii")
    n_base = sum(k.base for k in KINDS)
    count = lambda i: F.size(F.filter("pii", lambda s: s["kind_no"] == i)).cast("long")
    base = F.filter("pii", lambda s: s["kind_no"] < n_base)
    return df.select(
        "doc_id", *(count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.base),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("pii")).alias("spans"),
        *(count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if not k.base),
        F.array_max(F.transform("pii", lambda s: s["score"])).alias("max_score"))
