"""Operator 9: documents whose word shingles overlap, by parity sketches.

A text's set is its distinct shingles, as 64-bit hashes.  Texts with equal sets
are one class.  A link means intersection / union >= num / den, so two linked
sets, the smaller of size a, differ in at most ``a * (den - num) / num``
shingles.

1. Size bands.  Bands are a factor of den / num wide, so linked sets lie in one
   band or in neighbouring ones; each set takes part in its own band and in the
   one below.  A band's sets are cut by hash ranges into one block more than
   the most differences it allows: linked sets agree in a whole block.
2. A block's shingles are XORed into a word; band, block and word make a key.
   One pass over the texts names the sets, makes their keys and a parity bit
   sketch of each: its Hamming distance to another's is at most the number of
   differences.  Keys travel packed by hash of the key.
3. Sets that share a key are a group.  Each is compared, by sketch and size, with
   the least of its group.  Groups in which one fails are compared pair by pair,
   since any two of them may be near.  Only pairs whose sketches pass join sets
   to parts, so texts that merely share a passage do not.
4. Shingles are made again for the sets in parts alone.  They meet in units of
   bounded size: small parts together, a large part cut into chunks of which any
   two meet; pairs whose sketches pass are verified on the sets.  Each pair meets
   in one unit.  A unit gives a spanning forest of its links and, where asked
   for, how many rows are linked to each set, or the links themselves.
5. Connected components of the forests are the classes.  A row's links are the
   other rows of its set and the rows of all sets linked to it.  Where classes
   alone are asked for, pairs that a unit has joined already are not verified.

Tables of the shared folder that nothing needs any more are deleted.

An empty block says nothing and gives no key, which could lose a pair whose
only common blocks are empty.  That needs every difference in a block of its
own: sets that allow more than ``SURE`` differences would need a chance under
e^-40 for it; smaller ones with an empty block are cut again with another hash
until a cut has none (at most ``CUTS`` times; then the whole set is compared
with all sets of its band that got as far, by one key for the band).

Defined results: a null or empty text, or one of blanks, has an empty set, no
link and its own id as class; a class without any id has a null one; a null ``doc_id``
counts as larger than any; repeated rows are in one class; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import LOWER_AZ, discard, id_and_text, read_documents
from .components import components

SURE, CUTS = 40, 24
#: Words in a worker's hash cache, bytes of the longest one in it; keys that a task holds; text characters a bucket.
CACHE, CACHED_WORD, PACK_KEYS, BUCKET_CHARS = 200_000, 64, 500_000, 4 << 20
#: Shingles and sets in one unit; sets of one group compared in one unit; shingles looked up at a time.
UNIT_SHINGLES, UNIT_SETS, GROUP_SETS, GATHERED = 1_000_000, 1024, 4096, 500_000
#: Most rows of a table of ids that is broadcast; larger ones are joined by shuffle.
MOST_BROADCAST = 500_000

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED_WORD:
            if len(self) >= CACHE:
                self.clear()
            self[word] = h
        return h


def shingle_set(text: str, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; the whole sequence if it has fewer words."""
    words = text.encode().translate(LOWER_AZ).split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    size = min(width, n)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = out * _U(0x9E3779B97F4A7C15) + h[i:n - size + 1 + i]
    return np.unique(mix(out))


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    total = mix(shingles ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + _U(len(shingles))
    return int(mix(np.array([total]))[0].astype(np.int64))


@dataclass(frozen=True)
class Link:
    """num / den is the least similarity, ``width`` the words of a shingle."""

    width: int = 5
    num: int = 4
    den: int = 5

    def band(self, size: int) -> int:
        """The band of a set size; ``top`` is a band's largest size."""
        band = max(0, int(np.log(size) / np.log(self.den / self.num)) - 1)
        while self.top(band) < size:
            band += 1
        return band

    def top(self, band: int) -> int:
        return int((self.den / self.num) ** (band + 1))

    def differences(self, band: int) -> int:
        """The most by which a set of the band and one as large or larger can differ."""
        return self.top(band) * (self.den - self.num) // self.num

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        own = self.band(len(shingles))
        return np.concatenate([self._keys(shingles, band) for band in range(max(0, own - 1), own + 1)])

    def _keys(self, shingles: np.ndarray, band: int) -> np.ndarray:
        most, out, cut = self.differences(band), [], shingles
        blocks = most + 1
        for again in range(CUTS):
            if again:
                cut = np.sort(mix(shingles + _U(again)))
            block = ((cut >> _U(32)) * _U(blocks)) >> _U(32)
            starts = np.flatnonzero(np.diff(block, prepend=_U(blocks)))
            name = (_U(band) << _U(40)) + (_U(again) << _U(34)) + block[starts]
            out.append(mix(np.bitwise_xor.reduceat(cut, starts) ^ mix(name)))
            if len(starts) == blocks or most > SURE:
                return np.concatenate(out)
        return np.concatenate([*out, mix(np.array([_U(band) << _U(20)]))])

    def bits(self, size: int) -> int:
        """The bits of a set's sketch: enough for the differences that it may have, a power of two."""
        most = 2 * size * (self.den - self.num) // (self.den + self.num) + 1
        return 1 << min(16, max(8, int(8 * most - 1).bit_length()))

    def near(self, apart, sizes):
        """Whether sets of so many shingles together may be linked, so many bits of whose sketches differ."""
        return apart * (self.den + self.num) <= sizes * (self.den - self.num)


_PASS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64()), ("sketch", pa.binary()),
                   ("bucket", pa.int64()), ("keys", pa.binary()), ("sids", pa.binary()), ("counts", pa.binary())])


def _pass(docs: DataFrame, link: Link, buckets: int) -> DataFrame:
    """Two kinds of rows: (doc_id, n_shingles, sid, sketch) of every row, ``sid`` being null for an empty set and
    ``sketch`` there when its task meets the set first; and (bucket, keys, sids, counts), packed keys of these sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, keys, sids, held = WordHashes(), set(), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            key = np.concatenate(keys)
            owner = np.repeat(np.arange(len(sids)), [len(k) for k in keys])
            bucket = (key % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            key, owner, bucket = key[order], owner[order], bucket[order]
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            names, out = np.array(sids, np.int64), []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)], strict=True):
                first = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
                out.append({"bucket": int(bucket[a]), "keys": key[a:b].tobytes(), "sids": names[owner[a:b][first]].tobytes(),
                            "counts": np.diff(first, append=b - a).astype(np.uint32).tobytes()})
            yield pa.RecordBatch.from_pylist(out, _PASS)

        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shingles = shingle_set(text.as_py(), link.width, hashes)
                row = {"doc_id": doc_id, "n_shingles": len(shingles)}
                if len(shingles):
                    sid = row["sid"] = set_id(shingles)
                    if sid not in seen:
                        seen.add(sid)
                        row["sketch"] = parity_bits(shingles, link.bits(len(shingles))).tobytes()
                        keys.append(link.keys(shingles))
                        sids.append(sid)
                        held += len(keys[-1])
                out.append(row)
                if held > PACK_KEYS:
                    yield from flush()
                    keys, sids, held, seen = [], [], 0, set()
            yield pa.RecordBatch.from_pylist(out, _PASS)
        if keys:
            yield from flush()

    return id_and_text(docs).mapInArrow(
        run, "doc_id long, n_shingles long, sid long, sketch binary, bucket long, keys binary, sids binary, counts binary")


def _groups(packed: DataFrame) -> DataFrame:
    """(gid, m, center, sid): the sets with a key, from the second on, with their number and the least of them; once for all
    keys of a bucket that the same sets share."""
    schema = pa.schema([("gid", pa.int64()), ("m", pa.int64()), ("center", pa.int64()), ("sid", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in group["keys"].to_pylist()])
        sids = np.concatenate([np.repeat(np.frombuffer(s, np.int64), np.frombuffer(c, np.uint32))
                               for s, c in zip(group["sids"].to_pylist(), group["counts"].to_pylist(), strict=True)])
        order = np.argsort(keys, kind="stable")
        keys, sids = keys[order], sids[order]
        starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        sizes = np.diff(starts, append=len(keys))
        found: dict[int, np.ndarray] = {}
        for a, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            members = np.unique(sids[a:a + n])
            if len(members) > 1:
                found[xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63)] = members
        if not found:
            return schema.empty_table()
        rest = [len(m) - 1 for m in found.values()]
        return pa.table([np.repeat(np.fromiter(found, np.int64, len(found)), rest), np.repeat(np.array(rest, np.int64) + 1, rest),
                         np.repeat(np.array([m[0] for m in found.values()]), rest), np.concatenate([m[1:] for m in found.values()])],
                        schema=schema)

    return packed.groupBy("bucket").applyInArrow(run, "gid long, m long, center long, sid long")


def folded(sketch: int, bits: int, to: int) -> int:
    """A parity sketch of fewer bits, from one of more."""
    while bits > to:
        bits //= 2
        sketch = (sketch >> bits) ^ (sketch & ((1 << bits) - 1))
    return sketch


def _passes(link: Link, a: bytes, n_a: int, b: bytes, n_b: int) -> bool:
    bits = 8 * min(len(a), len(b))
    apart = folded(int.from_bytes(a, "little"), 8 * len(a), bits) ^ folded(int.from_bytes(b, "little"), 8 * len(b), bits)
    return link.near(apart.bit_count(), n_a + n_b)


def _checked(edges: DataFrame, sketches: DataFrame, link: Link) -> DataFrame:
    """(center, sid, near) of each edge (center, sid), by the sketches (sid, n, sketch)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("sketch", "n", "sketch_2", "n_2")), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("center"), batch.column("sid"), pa.array([_passes(link, *r) for r in rows], pa.bool_())],
                                             names=["center", "sid", "near"])

    other = sketches.select(F.col("sid").alias("center"), F.col("n").alias("n_2"), F.col("sketch").alias("sketch_2"))
    return edges.join(sketches, "sid").join(other, "center").select("center", "sid", "sketch", "n", "sketch_2", "n_2").mapInArrow(
        run, "center long, sid long, near boolean")


def _sized(df: DataFrame) -> DataFrame:
    """``df``, a written table, with a hint to broadcast it if it has few rows."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


class _Forest:
    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        self.parent[a] = b
        return a != b


def _chunked(rows: DataFrame, group: str, chunks: DataFrame, units: int) -> DataFrame:
    """``rows`` with ``unit`` and the chunks ``a`` <= ``b`` that meet in it.  Groups without a row in ``chunks`` (group,
    chunks) are whole, many to a unit; a chunk of another meets itself and each other chunk once."""
    rows = rows.join(_sized(chunks), group, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long")))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("sid"), F.col("chunks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    a, b = F.least("chunk", "other"), F.greatest("chunk", "other")
    unit = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64(group), F.lit(units)).cast("string")).otherwise(F.concat_ws(":", group, a, b))
    return rows.withColumn("a", a).withColumn("b", b).withColumn("unit", unit)


def _compared(spark: SparkSession, groups: DataFrame, failed: DataFrame, sketches: DataFrame, link: Link) -> DataFrame:
    """(u, v): a spanning forest of the pairs whose sketches pass, within each group that has an edge in ``failed``."""
    bad = groups.filter("m > 2").join(_sized(failed), ["center", "sid"], "left_semi").select("gid").distinct()
    bad = materialize(spark, bad, "jaccard-bad")
    members = groups.join(_sized(bad), "gid", "left_semi").select("gid", "m", F.explode(F.array("center", "sid")).alias("sid")).distinct()
    members = materialize(spark, members.join(_sized(sketches), "sid"), "jaccard-members")
    large = materialize(spark, members.filter(F.col("m") > GROUP_SETS).select("gid", F.ceil(F.col("m") / GROUP_SETS).alias("chunks")).distinct(), "jaccard-large")
    units = members.count() // 20_000 + int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(group: pa.Table) -> pa.Table:
        sets: dict[int, list[tuple]] = {}
        for gid, *row in zip(*(group[c].to_pylist() for c in ("gid", "chunk", "sid", "n", "sketch")), strict=True):
            sets.setdefault(gid, []).append(tuple(row))
        a, b = group["a"][0].as_py(), group["b"][0].as_py()
        out = []
        for rows in sets.values():
            rows.sort(key=lambda r: r[:2])
            split = None if a == b else sum(r[0] == a for r in rows)
            bits = 8 * min(len(r[3]) for r in rows)
            flat = [folded(int.from_bytes(r[3], "little"), 8 * len(r[3]), bits) for r in rows]
            sketch = np.frombuffer(b"".join(f.to_bytes(bits // 8, "little") for f in flat), np.uint64).reshape(len(rows), -1)
            size, ids, forest = np.array([r[2] for r in rows]), [r[1] for r in rows], _Forest(len(rows))
            for i in range(len(rows) if split is None else split):
                low = i + 1 if split is None else split
                apart = np.bitwise_count(sketch[low:] ^ sketch[i]).sum(1, dtype=np.int64)
                for j in (np.flatnonzero(link.near(apart, size[low:] + size[i])) + low).tolist():
                    if forest.join(i, j):
                        out.append((ids[i], ids[j]))
        us, vs = zip(*out, strict=True) if out else ((), ())
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    rows = _chunked(members, "gid", large, units).select("unit", "a", "b", "gid", "chunk", "sid", "n", "sketch")
    pairs = materialize(spark, rows.groupBy("unit").applyInArrow(run, "u long, v long").distinct(), "jaccard-pairs")
    discard(bad, members, large)
    return pairs


def _parts(spark: SparkSession, groups: DataFrame, sketches: DataFrame, link: Link) -> DataFrame:
    """(sid, root) of the sets that pairs with a common key and near sketches connect."""
    edges = materialize(spark, _checked(groups.select("center", "sid").distinct(), sketches, link), "jaccard-edges")
    near = edges.filter("near").select(F.col("center").alias("u"), F.col("sid").alias("v"))
    failed = edges.filter("not near").select("center", "sid")
    if not failed.isEmpty():
        near = near.unionByName(_compared(spark, groups, failed, sketches, link))
    parts = materialize(spark, components(spark, near).select(F.col("node").alias("sid"), "root"), "jaccard-parts")
    discard(edges)
    return parts


def _candidate_sets(docs: DataFrame, link: Link, wanted: DataFrame) -> DataFrame:
    """``wanted`` (sid, root, n, rows, least) with the shingles of its sets, made from the documents with the ids ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = {set_id(s): s for s in (shingle_set(t.as_py(), link.width, hashes) for t in batch.column(0)) if len(s)}
            yield pa.RecordBatch.from_pydict({"sid": pa.array(sets.keys(), pa.int64()),
                                              "shingles": pa.array([s.tobytes() for s in sets.values()], pa.binary())})

    ids = _sized(wanted.select(F.col("least").alias("_id")).distinct())
    texts = id_and_text(docs)
    texts = texts.join(ids, texts["doc_id"].eqNullSafe(ids["_id"]), "left_semi").select("text")
    sets = texts.mapInArrow(run, "sid long, shingles binary").join(_sized(wanted.select("sid", "root", "n", "rows")), "sid")
    return sets.groupBy("sid").agg(*(F.first(c).alias(c) for c in ("root", "n", "rows", "shingles")))


def parity_bits(shingles: np.ndarray, bits: int) -> np.ndarray:
    """For each of ``bits`` (a power of two) hash values, whether an odd number of shingles has it."""
    odd = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def links_among(link: Link, sets: list[np.ndarray], split: int | None = None,
                classes_only: bool = False) -> Iterator[tuple[int, np.ndarray, list[int]]]:
    """For each set with links to sets after it: its place, theirs, and those of them that join a spanning
    forest; with ``split``, only links between the sets before it and the others; with ``classes_only``, no
    links between sets that are connected already."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    bits = link.bits(int(size.max()))
    sketch = np.stack([parity_bits(s, bits) for s in sets])
    # the sets in numbers from 0, so that those of one set can be marked and looked up in others
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    numbered = np.split(numbers, np.cumsum(size)[:-1])
    marked = np.zeros(int(numbers.max()) + 1, np.uint8)
    forest = _Forest(n)

    def linked_to(i: int, near: np.ndarray) -> np.ndarray:
        both, at = np.empty(len(near), np.int64), 0
        marked[numbered[i]] = 1
        while at < len(near):  # so many at a time that they stay small
            some = near[at:at + max(1, GATHERED // int(size[near[at:]].max()))]
            starts = np.cumsum(size[some]) - size[some]
            both[at:at + len(some)] = np.add.reduceat(marked[np.concatenate([numbered[j] for j in some.tolist()])], starts, dtype=np.int64)
            at += len(some)
        marked[numbered[i]] = 0
        return near[link.den * both >= link.num * (size[i] + size[near] - both)]

    for i in range(n if split is None else split):
        low = i + 1 if split is None else split
        apart = np.bitwise_count(sketch[low:] ^ sketch[i]).sum(1, dtype=np.int64)
        near = np.flatnonzero(link.near(apart, size[low:] + size[i])) + low
        if classes_only and len(near):
            near = np.array([j for j in near.tolist() if forest.find(j) != forest.find(i)], np.int64)
        if len(near) and len(near := linked_to(i, near)):
            yield i, near, [j for j in near.tolist() if forest.join(i, j)]


def _links(spark: SparkSession, sets: DataFrame, link: Link, give: str) -> DataFrame:
    """(u, linked, tree, more) of sets in each unit: ``tree``, the sets whose links to u are in a spanning forest of the
    unit; unless ``give`` is "classes", ``more``, how many rows the unit finds linked to a row of u; if it is "links",
    ``linked``, the sets linked to u, each link in one row of one unit."""
    sizes = sets.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    sizes = sizes.select("root", F.greatest(F.ceil(F.col("m") / UNIT_SETS), F.ceil(F.col("total") / UNIT_SHINGLES)).alias("chunks"))
    large = materialize(spark, sizes.filter("chunks > 1"), "jaccard-large")
    total = sets.agg(F.sum("n")).first()[0] or 0
    units = int(total // UNIT_SHINGLES) + int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _chunked(sets, "root", large, units).select("unit", "a", "b", "root", "chunk", "sid", "rows", "shingles")
    schema = pa.schema([("u", pa.int64()), ("linked", pa.list_(pa.int64())), ("tree", pa.list_(pa.int64())), ("more", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        members: dict[int, list[tuple[int, int, int, bytes]]] = {}
        for root, *row in zip(*(group[c].to_pylist() for c in ("root", "chunk", "sid", "rows", "shingles")), strict=True):
            members.setdefault(root, []).append(tuple(row))
        a, b = group["a"][0].as_py(), group["b"][0].as_py()
        out = []
        for rows in members.values():
            rows.sort(key=lambda r: r[:2])
            split = None if a == b else sum(r[0] == a for r in rows)
            if len(rows) > 1 and split != len(rows):
                ids, times = (np.array([r[k] for r in rows], np.int64) for k in (1, 2))
                more, found = np.zeros(len(rows), np.int64), {}
                for i, near, tree in links_among(link, [np.frombuffer(r[3], np.uint64) for r in rows], split, give == "classes"):
                    more[i] += times[near].sum()
                    more[near] += times[i]
                    found[i] = near, tree
                none = np.empty(0, np.int64)
                for i in (found if give == "classes" else np.flatnonzero(more).tolist()):
                    near, tree = found.get(i, (none, []))
                    out.append({"u": int(ids[i]), "linked": ids[near] if give == "links" else none, "tree": ids[tree] if tree else none,
                                "more": 0 if give == "classes" else int(more[i])})
        return pa.Table.from_pylist(out, schema)

    links = rows.groupBy("unit").applyInArrow(run, "u long, linked array<long>, tree array<long>, more long")
    links = materialize(spark, links, "jaccard-links")
    discard(large)
    return links


def _joined(spark: SparkSession, docs: DataFrame, link: Link, give: str) -> tuple[DataFrame, DataFrame]:
    chars = id_and_text(docs).agg(F.sum(F.length("text"))).first()[0] or 0
    made = materialize(spark, _pass(docs, link, max(128, chars // BUCKET_CHARS)), "jaccard-pass")
    groups = materialize(spark, _groups(made.filter("bucket is not null").select("bucket", "keys", "sids", "counts")).distinct(), "jaccard-groups")
    rows = made.filter("bucket is null").select("doc_id", "n_shingles", "sid")
    by_set = materialize(spark, rows.filter("sid is not null").groupBy("sid").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("rows"), F.first("n_shingles").alias("n")), "jaccard-sets")
    some = materialize(spark, groups.select(F.explode(F.array("center", "sid")).alias("sid")).distinct(), "jaccard-some")
    sketches = made.filter("sketch is not null").select("sid", F.col("n_shingles").alias("n"), "sketch").join(_sized(some), "sid", "left_semi")
    sketches = materialize(spark, sketches.groupBy("sid").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")), "jaccard-sketches")
    rows = materialize(spark, rows, "jaccard-rows")
    discard(made)
    parts = _parts(spark, groups, sketches, link)
    discard(groups, some, sketches)
    wanted = materialize(spark, by_set.join(_sized(parts), "sid"), "jaccard-wanted")
    candidates = materialize(spark, _candidate_sets(docs, link, wanted), "jaccard-candidates")
    links = _links(spark, candidates, link, give)
    discard(parts, wanted, candidates)
    linked = materialize(spark, components(spark, links.select("u", F.explode("tree").alias("v"))), "jaccard-linked")
    more = links.groupBy(F.col("u").alias("sid")).agg(F.sum("more").alias("more"))
    more = materialize(spark, more, "jaccard-more")
    by_set = by_set.join(_sized(linked.withColumnRenamed("node", "sid")), "sid", "left").join(_sized(more), "sid", "left")
    by_set = materialize(spark, by_set, "jaccard-classes")
    by_root = materialize(spark, by_set.filter("root is not null").groupBy("root").agg(F.min("least").alias("component_id")), "jaccard-roots")
    classes = by_set.join(_sized(by_root), "root", "left").select(
        "sid", F.coalesce("root", "sid").alias("class"), F.coalesce("component_id", "least").alias("component_id"),
        (F.col("rows") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    full = rows.filter("sid is not null").join(classes, "sid").select(
        "doc_id", "n_shingles", "sid", "class", "component_id", "n_links")
    full = full.unionByName(rows.filter("sid is null").select(
        "*", F.lit(None).cast("long").alias("class"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))
    return full, links


def joined(spark: SparkSession, docs: DataFrame, link: Link = Link()) -> tuple[DataFrame, DataFrame]:
    """``near_duplicates`` and the links (u, v) between different sets, by their names, each once."""
    full, links = _joined(spark, docs, link, "links")
    return full, links.select("u", F.explode("linked").alias("v"))


def near_duplicates(spark: SparkSession, docs: DataFrame, link: Link = Link()) -> DataFrame:
    """(doc_id, n_shingles, sid, class, component_id, n_links) of every row; ``class`` names the group (null: an empty set)."""
    return _joined(spark, docs, link, "counts")[0]


def keep_one(spark: SparkSession, docs: DataFrame, link: Link = Link()) -> DataFrame:
    """The rows of ``docs`` without all but one row of each class: the one with the least id, and of
    several such the one with the least set name, or any of them where that is the same too."""
    named = _joined(spark, docs, link, "classes")[0].select("doc_id", "sid", "class")
    rows = materialize(spark, named.groupBy("doc_id", "sid", "class").count(), "jaccard-named")
    first = rows.filter("class is not null").groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "sid")).alias("first"))
    first = materialize(spark, first, "jaccard-first")
    rows = rows.join(first, "class", "left").withColumn("stays", F.col("class").isNull() | (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("sid") == F.col("first.sid"))))
    rows = materialize(spark, rows.select(F.col("doc_id").alias("_id"), F.col("sid").alias("_gone"), "stays", "count",
                                          F.col("class").isNotNull().alias("grouped")), "jaccard-stays")
    # an id all of whose rows go needs no look at the texts; others (ids with several rows, no id) do
    ids = rows.groupBy("_id").agg(F.bool_or("stays").alias("some"), F.bool_or(~F.col("stays")).alias("gone"),
                                  F.max(F.when(F.col("stays") & F.col("grouped"), F.col("count"))).alias("most"))
    ids = materialize(spark, ids, "jaccard-ids")
    plain = ids.filter("_id is not null and gone and not some").select("_id")
    mixed = ids.filter("(gone and some) or most > 1 or (_id is null and gone)").select(F.col("_id").alias("_mixed"))
    discard(first)

    @F.pandas_udf("long")
    def names(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for texts in batches:
            sets = [shingle_set(t or "", link.width, hashes) for t in texts]
            yield pd.Series([set_id(s) if len(s) else None for s in sets], dtype="Int64")

    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
                        F.col("doc_id").cast("long").alias("_doc_id"), F.col("text").alias("_text"))
    plain = _sized(plain)
    kept = whole.join(plain, whole["_doc_id"] == plain["_id"], "left_anti")
    if mixed.isEmpty():
        return kept.select("_row.*")
    mixed = _sized(mixed)
    on = whole["_doc_id"].eqNullSafe(mixed["_mixed"])
    out = kept.join(mixed, on, "left_anti").select("_row")
    told = kept.join(mixed, on, "left_semi").select("_row", "_doc_id", names("_text").alias("_sid"))

    def matching(df: DataFrame, some: DataFrame, how: str) -> DataFrame:
        some = _sized(some)
        return df.join(some, df["_doc_id"].eqNullSafe(some["_id"]) & (df["_sid"] == some["_gone"]), how)

    told = matching(told, rows.filter("not stays").select("_id", "_gone"), "left_anti")
    again = rows.filter("stays and grouped and count > 1").select("_id", "_gone")
    out = out.unionByName(matching(told, again, "left_anti").select("_row")).unionByName(
        matching(told, again, "left_semi").dropDuplicates(["_doc_id", "_sid"]).select("_row"))
    return out.select("_row.*")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, read_documents(spark, sf_dir), Link(3, 9, 10)).select(
        "doc_id", "n_shingles", "component_id", "n_links")
