"""Operator 13: exact duplicates by composable polynomial fingerprints.

A text's bytes, A-Z lower-cased, are the digits of a number in base 256; its
fingerprint is that number modulo a prime, and its length.  Fingerprints
compose: those of two parts, ``f(xy) = f(x) * 256^len(y) + f(y)``.  So a huge
document is cut into chunks that any tasks hash; each hash is shifted by the
length that follows it, and what a document's chunks give is simply summed.

1. One pass names every row: length, fingerprint, SHA-256.  Chunks of huge
   documents leave it as rows and are hashed by others.
2. Rows with equal fingerprint and length are a group, counted with partial
   aggregation.
3. Texts of groups with copies are compared byte by byte: a task compares the
   texts that it holds itself and sends on one of each, in chunks; chunks with
   one group and place meet, sorted, and stream past the first of them.  A text
   that differs from the first of its group leaves it for a group by SHA-256,
   whose texts are compared in the same pass.
4. Group sizes and the ids that stay are joined back.  A group of any size is
   one row there; the join's rows can be split by Spark where a group is large.

Defined results: a null text is an empty one, and all empty texts are equal; a
null ``doc_id`` is less than any, and the one of a group without any id; of
rows with the same id and equal texts exactly one stays; an empty table gives
no row; other columns are ignored.  Two different texts with one length,
fingerprint and SHA-256 end the job with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import LOWER_AZ, id_and_text, read_documents

#: A safe prime: 256 has a large order modulo it.  Sums of 2^37 residues fit decimal(38).
MODULUS = 309485009821345068724780259
#: Bytes of a chunk; a text of more than HUGE is hashed in chunks by many tasks.
CHUNK, HUGE = 1 << 18, 1 << 24
#: Bytes of texts that a task holds to compare others with; rows whose keys are broadcast, others are joined by shuffle.
HELD, MOST_BROADCAST = 64 << 20, 200_000

_NUMBER = pa.decimal128(38, 0)


def polynomial(data: bytes, modulus: int = MODULUS) -> int:
    return int.from_bytes(data, "big") % modulus


def shifted(value: int, following: int, modulus: int = MODULUS) -> int:
    """What a chunk's hash adds to a document's, if so many bytes follow it."""
    return value * pow(256, following, modulus) % modulus


def composed(parts: Iterable[tuple[int, int]], modulus: int = MODULUS) -> int:
    """The fingerprint of parts, in order, given as (fingerprint, length)."""
    total = 0
    for value, length in parts:
        total = (shifted(total, length, modulus) + value) % modulus
    return total


def _numbers(values: Iterable[int | None]) -> pa.Array:
    return pa.array([None if v is None else Decimal(v) for v in values], _NUMBER)


def _named(docs: DataFrame, modulus: int, huge: int, chunk: int) -> DataFrame:
    """(rid, doc_id, n, fp, name, at, data): every row without ``at`` and ``data``; a huge one has no ``fp``
    but its chunks follow, as rows of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, ids, texts = batch.columns
            out: list[tuple] = []
            for rid, doc_id, text in zip(rids.to_pylist(), ids.to_pylist(), texts, strict=True):
                data = text.as_py().encode().translate(LOWER_AZ)
                n = len(data)
                whole = n <= huge
                out.append((rid, doc_id, n, polynomial(data, modulus) if whole else None, hashlib.sha256(data).digest(), None, None))
                if not whole:
                    yield _batch(out)
                    for at in range(0, n, chunk):
                        yield _batch([(rid, None, n, None, None, at, data[at:at + chunk])])
                    out = []
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        rid, doc_id, n, fp, name, at, data = map(list, zip(*rows, strict=True)) if rows else ([] for _ in range(7))
        return pa.RecordBatch.from_arrays(
            [pa.array(rid, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(n, pa.int64()), _numbers(fp),
             pa.array(name, pa.binary()), pa.array(at, pa.int64()), pa.array(data, pa.binary())],
            names=["rid", "doc_id", "n", "fp", "name", "at", "data"])

    rows = id_and_text(docs).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    return rows.mapInArrow(run, "rid long, doc_id long, n long, fp decimal(38,0), name binary, at long, data binary")


def _from_chunks(chunks: DataFrame, modulus: int) -> DataFrame:
    """(rid, sum): the fingerprint of each document from its chunks (rid, n, at, data), hashed wherever they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n", "at", "data")), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), _numbers(
                shifted(polynomial(d, modulus), n - at - len(d), modulus) for n, at, d in rows)], names=["rid", "part"])

    hashed = chunks.select("rid", "n", "at", "data").repartition("rid", "at").mapInArrow(run, "rid long, part decimal(38,0)")
    total = F.sum("part") % F.lit(Decimal(modulus)).cast("decimal(28,0)")
    return hashed.groupBy("rid").agg(total.cast("decimal(38,0)").alias("sum"))


def fingerprints(spark: SparkSession, docs: DataFrame, modulus: int = MODULUS, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """(rid, doc_id, n, fp, name) of every row: a number of the row, bytes, fingerprint and SHA-256 of its lower-cased text."""
    table = materialize(spark, _named(docs, modulus, huge, chunk), "dedup-names")
    rows = table.filter("at is null").select("rid", "doc_id", "n", "fp", "name")
    if rows.filter("fp is null").isEmpty():
        return rows
    sums = _from_chunks(table.filter("at is not null"), modulus)
    rows = rows.join(sums, "rid", "left").select("rid", "doc_id", "n", F.coalesce("fp", "sum").alias("fp"), "name")
    return materialize(spark, rows, "dedup-fingerprints")


def _differing(spark: SparkSession, docs: DataFrame, groups: DataFrame, modulus: int, chunk: int) -> DataFrame:
    """(n, fp, name) of the texts in ``groups`` (n, fp) that differ from the first of their group, by name."""
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [t.as_py().encode().translate(LOWER_AZ) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(len, data), pa.int64()), _numbers(polynomial(d, modulus) for d in data), pa.array(data, pa.binary())],
                names=["n", "fp", "data"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], bytes] = {}
        size = 0
        for batch in batches:
            for n, fp, value in zip(*(batch.column(c) for c in ("n", "fp", "data")), strict=True):
                data = value.as_py()
                key = (fp.as_py(), hashlib.sha256(data).digest())
                if held.get(key) == data:  # sent on already
                    continue
                if size + len(data) > HELD:
                    held, size = {}, 0
                if len(data) <= HELD:
                    held[key] = data
                    size += len(data)
                for at in range(0, max(1, len(data)), chunk):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n.as_py()], pa.int64()), _numbers([key[0]]), pa.array([at], pa.int64()),
                         pa.array([key[1]], pa.binary()), pa.array([data[at:at + chunk]], pa.binary())],
                        names=["n", "fp", "at", "name", "data"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, name, first, own = None, None, b"", b""
        for batch in batches:
            out = []
            for n, fp, at, one, data in zip(*(batch.column(c).to_pylist() for c in ("n", "fp", "at", "name", "data")), strict=True):
                if (n, fp, at) != group:
                    group, name, first, own = (n, fp, at), one, data, data
                elif one != name:
                    name, own = one, data
                elif data != own:
                    raise RuntimeError(f"two texts of {n} bytes with the SHA-256 {one.hex()}")
                if data != first:
                    out.append((n, fp, one))
            ns, fps, ones = map(list, zip(*out, strict=True)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(ns, pa.int64()), pa.array(fps, _NUMBER), pa.array(ones, pa.binary())],
                                             names=["n", "fp", "name"])

    few = groups.count() <= MOST_BROADCAST
    lengths = groups.select("n").distinct()
    texts = id_and_text(docs).select("text")
    if few:  # else every text is looked up by its fingerprint
        texts = texts.join(F.broadcast(lengths), F.octet_length("text") == lengths["n"], "left_semi")
    named = texts.mapInArrow(names, "n long, fp decimal(38,0), data binary")
    named = named.join(F.broadcast(groups) if few else groups, ["n", "fp"], "left_semi")
    pieces = named.mapInArrow(chunks, "n long, fp decimal(38,0), at long, name binary, data binary")
    pieces = pieces.repartition("n", "fp", "at").sortWithinPartitions("n", "fp", "at", "name")
    return pieces.mapInArrow(compare, "n long, fp decimal(38,0), name binary").distinct()


def exact_groups(spark: SparkSession, docs: DataFrame, modulus: int = MODULUS, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, name) of every row; ``name`` is the SHA-256 of its lower-cased text."""
    rows = fingerprints(spark, docs, modulus, huge, chunk)
    groups = materialize(spark, rows.groupBy("n", "fp").count().filter("count > 1").select("n", "fp"), "dedup-groups")
    odd = materialize(spark, _differing(spark, docs, groups, modulus, chunk), "dedup-differing")
    rows = rows.withColumn("apart", F.lit(None).cast("binary"))
    if not odd.isEmpty():
        rows = rows.drop("apart").join(odd.withColumn("apart", F.col("name")), ["n", "fp", "name"], "left")
    rows = rows.withColumn("apart", F.coalesce("apart", F.lit(b"")))
    copies = rows.groupBy("n", "fp", "apart").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "rid")).alias("last")).filter("group_size > 1")
    copies = materialize(spark, copies, "dedup-copies")
    joined = rows.join(copies, ["n", "fp", "apart"], "left")
    return joined.select(
        "doc_id", F.when(F.col("last").isNull(), F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("last.rid") == F.col("rid"), F.lit(True)).alias("kept"), "name")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark, read_documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("name")).alias("text_sha256"))


OP13_SQL = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM texts
"""
