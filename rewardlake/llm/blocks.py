"""A distinct-word dictionary joined back to whole texts, block by block.

Neighbouring documents form blocks (``common.with_blocks``).  Each block sends
its distinct words, by a hash of the word, to buckets; a bucket sees every
word of its share of the vocabulary once, gives each its value, and answers
each block.  A block's texts and answers then meet by block.  What moves is
compressed: the texts once, a block's distinct words once or twice.  A frequent
word counts once a block, so no word makes a bucket hot.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

#: Words of open blocks that a task holds, and text bytes in one compressed row.
OPEN_WORDS, TEXT_BYTES = 1_000_000, 4 << 20
#: No byte of UTF-8 text.
SEPARATOR = b"\xff"


def bucket_count(spark: SparkSession) -> int:
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_words(words: Iterable[bytes]) -> bytes:
    return squeeze(SEPARATOR.join(words))


def unpack_words(data: bytes) -> list[bytes]:
    return expand(data).split(SEPARATOR)


def shares(words: Iterable[bytes], buckets: int) -> dict[int, list[bytes]]:
    """Distinct words by bucket, in order: whoever has a block's texts can tell what each bucket got."""
    out: dict[int, list[bytes]] = {}
    for word in sorted(words):
        out.setdefault(zlib.crc32(word) % buckets, []).append(word)
    return out


def block_words(docs: DataFrame, add: Callable[[Counter[bytes], dict], None], buckets: int) -> DataFrame:
    """(block, bucket, words, counts): what ``add(counter, row)`` counts in the rows of a block.

    A block may come in several rows a bucket, if its task ran out of room or
    a file was split within it.
    """
    def rows(block: int, counter: Counter[bytes]) -> Iterator[dict]:
        for bucket, words in shares(counter, buckets).items():
            counts = pa.array([counter[w] for w in words], pa.uint64()).buffers()[1].to_pybytes()
            yield {"block": block, "bucket": bucket, "words": pack_words(words), "counts": squeeze(counts[:8 * len(words)])}

    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, Counter[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for block, counter in open_.items():
                if counter:
                    yield pa.RecordBatch.from_pylist(list(rows(block, counter)), schema)

        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                counter = open_.setdefault(one["block"], Counter())
                before = len(counter)
                add(counter, one)
                size += len(counter) - before
                if size > OPEN_WORDS:
                    yield from flush()
                    open_, size = {}, 0
        yield from flush()

    return docs.mapInArrow(run, "block long, bucket long, words binary, counts binary")


def block_texts(docs: DataFrame) -> DataFrame:
    """(block, docs): rows of ``docs`` without ``block``, as compressed Arrow streams of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_pylist()
            rest = batch.drop_columns(["block"])
            sizes = [len(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            parts: dict[int, list[list[int]]] = {}
            room: dict[int, int] = {}
            for i, (block, size) in enumerate(zip(blocks, sizes, strict=True)):
                if block not in parts or room[block] < size:
                    parts.setdefault(block, []).append([])
                    room[block] = TEXT_BYTES
                parts[block][-1].append(i)
                room[block] -= size
            for block, groups in parts.items():
                for group in groups:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rest.schema) as writer:
                        writer.write_batch(rest.take(pa.array(group)))
                    yield pa.RecordBatch.from_pydict({"block": [block], "docs": [squeeze(sink.getvalue().to_pybytes())]})

    return docs.mapInArrow(run, "block long, docs binary")


def rows_of(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(expand(data)).read_all()
