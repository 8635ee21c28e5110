"""Operator 8: order MinHash fingerprints, in DataFrame functions only.

A text's k-mers are runs of ``K`` units.  A unit is a word; a word of over
``WORD`` code points (a run of Chinese, Japanese or Thai, or encoded data) has
one for each of its code points, which is that and the ``GRAM - 1`` after it.
What a word's units are follows from the word alone, so an edit changes only
the k-mers about it.  Each k-mer is numbered by its occurrence
in the text; a hash of k-mer and number orders these pairs and deals them, by
its upper bits, to 64 bins; a bin's ``LEAST`` smallest pairs, put back in text
order, are hashed to one entry.  Two texts agree in a bin if the same pairs are least
there and stand in the same order, so moving text around lowers the likeness
as edit distance does, unlike with plain MinHash.

Everything works on arrays of longs within a row: a hash in the upper bits and
a place (below 2^24) in the lower ones, so that sorting is on primitives.

Defined results: a null or empty text, or one of blanks, has an empty
fingerprint, and two empty ones are fully alike; the last
k-mers of a text are shorter, so that one word is enough; rows are ordered by ``doc_id`` (null first), then by a
hash of the text; rows equal in both are one document to its neighbours, and
each is returned; the only document is its own next; an empty table gives no
row; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_and_text, read_documents

#: Units of a k-mer, code points of a word that is one unit, of a unit of a longer one, bits of a bin's number,
#: pairs that make an entry.
K, WORD, GRAM, _BIN, LEAST = 3, 16, 4, 6, 2
_PLACE = 24  # bits of a place; units beyond the last share it, and go by hash
_MASK = (1 << _PLACE) - 1


def _starts(packed: Column, shift: int) -> Column:
    """Places in a sorted array where the bits above ``shift`` change."""
    return F.filter(F.transform(packed, lambda x, i: F.when(
        (i > 0) & (F.shiftright(x, shift) == F.shiftright(F.get(packed, i - 1), shift)), F.lit(-1)).otherwise(i)),
        lambda i: i >= 0)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` plus ``out``: an int for each bin in use, the bin's number above 25 bits of hash."""
    own, t = df.columns, F.col(text)
    df = df.select(*own, F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "").alias("_w"))

    def units(points: Column) -> Column:  # a short word is the only one of its array
        return F.transform(points, lambda x, i: F.xxhash64(x, *(F.get(points, i + j) for j in range(1, GRAM))))
    points = F.transform("_w", lambda w: F.when(F.length(w) > WORD, F.split(w, "")).otherwise(F.array(w)))
    # without a long word both ways give the same
    df = df.select(*own, F.when(F.exists("_w", lambda w: F.length(w) > WORD), F.flatten(F.transform(points, units)))
                   .otherwise(F.transform("_w", lambda w: F.xxhash64(w))).alias("_w"))
    # k-mers, shorter at the end of the text, with an empty place
    df = df.select(*own, F.transform("_w", lambda w, i: F.xxhash64(w, *(F.get("_w", i + j) for j in range(1, K)))
                                     .bitwiseAND(F.lit(~_MASK))).alias("_h"))
    df = df.select(*own, (F.size(F.array_distinct("_h")) < F.size("_h")).alias("_again"),
                   F.sort_array(F.transform("_h", lambda h, i: h.bitwiseOR(F.least(i, F.lit(_MASK)).cast("bigint")))).alias("_s"))
    # equal k-mers stand side by side: a second or later occurrence gets a hash of its own
    df = df.select(*own, "_s", F.when(F.col("_again"), _starts(F.col("_s"), _PLACE)).alias("_r"))
    df = df.select(*own, "_s", F.when(F.col("_r").isNotNull(), F.flatten(F.transform("_r", lambda at, j: F.sequence(
        F.lit(1), F.coalesce(F.get("_r", j + 1), F.size("_s")) - at)))).alias("_n"))

    def numbered(x: Column, i: Column) -> Column:
        n = F.coalesce(F.get("_n", i), F.lit(1))
        return F.when(n > 1, F.xxhash64(F.shiftright(x, _PLACE), n).bitwiseAND(F.lit(~_MASK))
                      .bitwiseOR(x.bitwiseAND(F.lit(_MASK)))).otherwise(x)
    df = df.select(*own, F.when(F.col("_n").isNotNull(), F.sort_array(F.transform("_s", numbered)))
                   .otherwise(F.col("_s")).alias("_s"))
    df = df.select(*own, "_s", _starts(F.col("_s"), 64 - _BIN).alias("_r"))

    def entry(at: Column, j: Column) -> Column:
        n = F.least(F.lit(LEAST), F.coalesce(F.get("_r", j + 1), F.size("_s")) - at)
        # the place above the hash: text order
        pairs = F.sort_array(F.transform(F.slice("_s", at + 1, n), lambda x: F.shiftleft(x, 64 - _PLACE).bitwiseOR(
            F.shiftrightunsigned(x, _PLACE))))
        value = F.xxhash64(F.transform(pairs, lambda x: x.bitwiseAND(F.lit((1 << (64 - _PLACE)) - 1))))
        return F.shiftleft(F.shiftrightunsigned(F.get("_s", at), 64 - _BIN), 31 - _BIN).bitwiseOR(
            F.shiftrightunsigned(value, 33 + _BIN)).cast("int")
    return df.select(*own, F.transform("_r", entry).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins in use in either fingerprint whose entries agree."""
    bins = lambda f: F.transform(f, lambda x: F.shiftright(x, 31 - _BIN))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.hex(x))), ".")


def next_rows(spark: SparkSession, keys: DataFrame) -> DataFrame:
    """Each distinct row of ``keys`` (a, b) with the one after it (next_a, next_b), the first after the last.

    Rows are dealt by range; within a range a window finds the next, and the
    ranges' first rows, one a partition, close the gaps.
    """
    ranged = keys.distinct().repartitionByRange("a", "b").withColumn("part", F.spark_partition_id())
    ranged = materialize(spark, ranged, "order")
    firsts = sorted(ranged.groupBy("part").agg(F.min(F.struct("a", "b")).alias("f")).collect())  # a row a partition
    after = [(p[0], *firsts[(i + 1) % len(firsts)][1]) for i, p in enumerate(firsts)]
    gaps = spark.createDataFrame(after, "part int, first_a long, first_b long")
    w = Window.partitionBy("part").orderBy("a", "b")
    following = ranged.withColumn("n", F.lead(F.struct("a", "b")).over(w)).join(F.broadcast(gaps), "part")
    following = following.withColumn("n", F.coalesce("n", F.struct(F.col("first_a").alias("a"), F.col("first_b").alias("b"))))
    return following.select("a", "b", F.col("n.a").alias("next_a"), F.col("n.b").alias("next_b"))


#: Stands for a null id in keys, so that it sorts first.
_NO_ID = -(1 << 63)


def fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (text), fingerprint, edited_fingerprint, near_next of every row."""
    rows = id_and_text(docs)
    rows = rows.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("a"), F.xxhash64("text").alias("b"), "text")
    signed = with_fingerprint(rows, "text", "fingerprint").select("a", "b", F.length("text").alias("n"), "fingerprint")
    signed = materialize(spark, signed.groupBy("a", "b").agg(F.first("n").alias("n"), F.first("fingerprint").alias("f")),
                         "fingerprints")
    following = next_rows(spark, signed.select("a", "b"))
    after = signed.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), F.col("f").alias("next_f"))
    chain = materialize(spark, signed.join(following, ["a", "b"]).join(after, ["next_a", "next_b"]).select(
        "a", "b", "next_a", "next_b", F.floor(F.col("n") / 4).cast("int").alias("take"), "f",
        likeness(F.col("f"), F.col("next_f")).alias("near_next")), "chain")
    wanted = chain.select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.col("next_a").alias("a"),
                          F.col("next_b").alias("b"), "take")
    given = rows.join(wanted, ["a", "b"]).select(F.col("to_a").alias("a"), F.col("to_b").alias("b"),
                                                 F.left("text", F.col("take")).alias("start"))
    given = given.groupBy("a", "b").agg(F.first("start").alias("start"))
    n = F.length("text")
    edited = rows.join(given, ["a", "b"]).join(chain.select("a", "b", "f", "near_next"), ["a", "b"]).select(
        F.nullif("a", F.lit(_NO_ID)).alias("doc_id"), n.cast("long").alias("n_chars"),
        F.concat(F.left("text", n - F.floor(n / 4).cast("int")), "start").alias("edited"),
        F.col("f").alias("fingerprint"), "near_next")
    return with_fingerprint(edited, "edited", "edited_fingerprint")


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints(spark, read_documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fingerprint")).alias("fingerprint"), as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), "near_next")
