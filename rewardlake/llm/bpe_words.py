"""Operator 7: byte-level BPE through a table of distinct words.

Texts are split into words (``bpe.keys_of``); Spark sends the distinct words
of each block of documents to hash buckets, where every word is encoded once;
the ids come back to the block and are laid out in the order of its texts.
Decoding is no join: each worker looks ids up in the list of the vocabulary's
pieces, whose size is fixed by its file.

Defined results: a null or empty text has no ids and decodes to an empty text;
a null ``doc_id`` stays null; repeated rows are each encoded; an empty table
gives no row; other columns of the input are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import block_texts, block_words, bucket_count, expand, rows_of, shares, squeeze, unpack_words
from .bpe import keys_of, pieces_of, vocabulary_paths, word_encoder
from .common import read_documents, with_blocks


def _add(counter: dict[bytes, int], row: dict) -> None:
    for key in set(keys_of(row["text"])):
        counter[key.encode()] = 0


def _answers(words: DataFrame) -> DataFrame:
    """(block, bucket, ids, sizes): the ids of each block's words, in the order of the words; a bucket
    encodes each of its words once."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary())])

    def run(group: pa.Table) -> pa.Table:
        encode, known = word_encoder(*vocabulary_paths()), {}
        of_block: dict[int, list[bytes]] = {}
        for block, data in zip(group["block"].to_pylist(), group["words"].to_pylist(), strict=True):
            of_block.setdefault(block, []).append(data)
        out = []
        for block, parts in of_block.items():
            words = unpack_words(parts[0]) if len(parts) == 1 else sorted({w for p in parts for w in unpack_words(p)})
            for word in words:
                if word not in known:
                    known[word] = encode(word.decode())
            ids = list(map(known.__getitem__, words))
            flat = np.frombuffer(b"".join(ids), "<u4")
            # two bytes an id where they are enough
            kind = "<u2" if flat.max(initial=0) < 1 << 16 else "<u4"
            out.append({"block": block, "bucket": group["bucket"][0].as_py(),
                        "ids": kind[-1].encode() + squeeze(flat.astype(kind).tobytes()),
                        "sizes": squeeze(np.array([len(i) // 4 for i in ids], "<u4").tobytes())})
        return pa.Table.from_pylist(out, schema)

    return words.groupBy("bucket").applyInArrow(run, "block long, bucket long, ids binary, sizes binary")


def encode(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, ids): ids of whole texts as little-endian unsigned 32-bit integers."""
    schema, buckets = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]), bucket_count(spark)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys: set[str] = set()
        for data in texts["docs"]:
            for text in rows_of(data.as_py())["text"]:
                keys.update(keys_of(text.as_py()))
        words, ids_of = shares([k.encode() for k in keys], buckets), {}
        del keys
        for bucket, ids, sizes in zip(*(answers[c].to_pylist() for c in ("bucket", "ids", "sizes")), strict=True):
            flat, at = np.frombuffer(expand(ids[1:]), "<u" + ids[:1].decode()).astype("<u4").tobytes(), 0
            for word, size in zip(words.pop(bucket), np.frombuffer(expand(sizes), "<u4").tolist(), strict=True):
                ids_of[word.decode()] = flat[at:at + 4 * size]
                at += 4 * size
        out = []
        for data in texts["docs"]:
            rows = rows_of(data.as_py())
            out.append(pa.table([rows["doc_id"], pa.array(
                (b"".join(map(ids_of.__getitem__, keys_of(t.as_py()))) for t in rows["text"]), pa.binary())], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    blocks = with_blocks(spark, docs)
    words = _answers(block_words(blocks.select("block", "text"), _add, buckets))
    return block_texts(blocks).groupBy("block").cogroup(words.groupBy("block")).applyInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame) -> DataFrame:
    """(doc_id, ids, text): the ids of each row looked up in the list of pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(vocabulary_paths()[0])
        for batch in batches:
            texts = [b"".join(map(pieces.__getitem__, array("I", i.as_py()))).decode("utf-8", "replace")
                     for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                                             names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def op7_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(encode(spark, read_documents(spark, sf_dir))).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
