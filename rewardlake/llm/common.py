"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: Lower-cases A-Z only, in UTF-8 bytes.
LOWER_AZ = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

#: Rows of a block by the longest text it may hold; longer texts get a block each.
BLOCK_ROWS = ((8_192, 8192), (65_536, 1024), (1_048_576, 64))


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def discard(*tables: DataFrame) -> None:
    """Deletes written tables (frames that ``materialize`` gave) that nothing will read again."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (null: empty); other columns are pruned from the scan."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def least_hashes(rows: DataFrame, count: int, n: int) -> DataFrame:
    """The ``n`` of ``count`` rows whose ids have the least hashes.  A bound on the hash leaves about 1.2 ``n``
    rows, so that no task holds or sends on more than its share of those."""
    key = F.xxhash64("doc_id")
    if count > 2 * n:
        rows = rows.filter(F.shiftrightunsigned(key, 24) < int((1 << 40) * 1.2 * n / count))
    return rows.orderBy(key, "doc_id").limit(n)


def with_blocks(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, text, block) of every row, as ``id_and_text`` gives them; ``block``,
    a long, names a bounded run of neighbouring rows of one file.

    The block follows from the file and the row's place in it alone, so it is
    the same however a scan is split or retried.  A frame that is not a plain
    file scan is written to the shared checkpoint folder first.
    """
    try:
        docs.select("_metadata.row_index").schema
    except AnalysisException:
        docs = materialize(spark, id_and_text(docs), "blocks")
    n, row = F.coalesce(F.length(docs["text"]), F.lit(0)), F.col("_metadata.row_index")
    size = F.lit(1)
    for longest, rows in reversed(BLOCK_ROWS):
        size = F.when(n <= longest, F.lit(rows)).otherwise(size)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"),
                       F.xxhash64(F.col("_metadata.file_path"), size, F.floor(row / size)).alias("block"))
