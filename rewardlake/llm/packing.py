"""Operator 5: harmonic packing of token sequences.

A document is its ids and one end id.  It is cut into pieces of the whole
capacity, then into the powers of two of what is left, down to ``SMALL``; the
last piece is shorter.  A piece of length n is of class ``capacity // n``, so
a class holds lengths in (capacity / (c + 1), capacity / c], and every bin of
the class takes exactly c of them.  Workers (partitions) fill their bins
without a shuffle; each keeps at most one open bin a class.  What is in the
open bins at the end is laid end to end, cut at the capacity, and the
remainder at powers of two, which are not padded.

Defined results: a null or empty text is the end id alone (one piece of
length 1); a null ``doc_id`` stays null; repeated rows are packed once each;
an empty table gives no row; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .bpe import TextEncoder, vocabulary_paths
from .common import id_and_text, read_documents

CAPACITY, END_ID, SMALL = 2048, 1, 64
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "size_class long")
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


def cut(n: int, capacity: int = CAPACITY, small: int = SMALL) -> list[int]:
    """Piece lengths of a document of n ids."""
    out, size = [capacity] * (n // capacity), capacity // 2
    n %= capacity
    while size >= small:
        if n >= size:
            out.append(size)
            n -= size
        size //= 2
    return out + [n] * (n > 0)


def powers(n: int) -> list[int]:
    """n as a sum of distinct powers of two, the largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class Packer:
    """Bins of one worker.  A piece is (doc_id, start, length, ids, doc_tokens)."""

    def __init__(self, worker: int, capacity: int = CAPACITY):
        self.next_id, self.capacity, self.open = worker << 40, capacity, {}

    def _close(self, pieces: list[tuple], size_class: int) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, length, ids, doc_tokens in pieces:
            yield (doc_id, start, length, zlib.crc32(ids), doc_tokens, self.next_id, offset, size_class)
            offset += length
        self.next_id += 1

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        """The rows of all bins that this document fills."""
        n, start = len(ids) // 4, 0
        for length in cut(n, self.capacity, SMALL):
            size_class = self.capacity // length
            bin_ = self.open.setdefault(size_class, [])
            bin_.append((doc_id, start, length, ids[4 * start:4 * (start + length)], n))
            start += length
            if len(bin_) == size_class:
                yield from self._close(self.open.pop(size_class), size_class)

    def finish(self) -> Iterator[tuple]:
        """Rows of what is in the open bins, with class 0."""
        rest = [piece for size_class in sorted(self.open) for piece in self.open[size_class]]
        total = sum(piece[2] for piece in rest)
        room, at = [self.capacity] * (total // self.capacity) + powers(total % self.capacity), 0
        for want in room:
            pieces = []
            while want:
                doc_id, start, length, ids, n = rest[at]
                take = min(length, want)
                pieces.append((doc_id, start, take, ids[:4 * take], n))
                want -= take
                if take == length:
                    at += 1
                else:
                    rest[at] = (doc_id, start + take, length - take, ids[4 * take:], n)
            yield from self._close(pieces, 0)


def pack(docs: DataFrame, encoder: Callable[[], Callable[[str], bytes]], capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents; ``encoder()`` makes, in a worker, the function from a text to its id bytes."""
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(), Packer(TaskContext.get().partitionId(), capacity)

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                              schema=_ARROW)

        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.extend(packer.add(doc_id, encode(text.as_py()) + end))
            if rows:
                yield table(rows)
        if rows := list(packer.finish()):
            yield table(rows)

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def packed(docs: DataFrame) -> DataFrame:
    """``pack`` with the public byte-level vocabulary and a capacity of 2048."""
    return pack(docs, lambda: TextEncoder(*vocabulary_paths()))


def op5_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_documents(spark, sf_dir))
