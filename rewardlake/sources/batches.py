"""SNK1 / SET4: appends that can be repeated.

A batch has an id.  Its rows are written to a folder of their own attempt; the
batch counts once the manifest names that attempt, in an entry called by the
batch's id that only one writer can create.  So a job that runs twice, two
writers of one batch, or files of an attempt that died leave each batch in
the table once, and readers never see half a batch.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFEST, ATTEMPTS = "_manifest", "attempts"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop = _fs(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def committed(spark: SparkSession, table: str) -> dict[str, str]:
    """The attempt that holds each committed batch."""
    fs, folder = _fs(spark, f"{table}/{MANIFEST}")
    if not fs.exists(folder):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.getLen() > 0]
    return {n: _read_text(spark, f"{table}/{MANIFEST}/{n}") for n in names if not n.startswith(".")}


def append_batch(df: DataFrame, table: str, batch_id: str) -> bool:
    """Appends ``df`` as JSON Lines under ``batch_id``; False if that batch is there already."""
    spark = df.sparkSession
    entry = f"{table}/{MANIFEST}/{batch_id}"
    fs, path = _fs(spark, entry)
    if fs.exists(path) and fs.getFileStatus(path).getLen() > 0:
        return False
    attempt = uuid.uuid4().hex
    df.write.option("ignoreNullFields", "false").json(f"{table}/{ATTEMPTS}/{attempt}")
    # an empty entry is one whose writer died: it may be replaced, a full one not
    replace = fs.exists(path) and fs.getFileStatus(path).getLen() == 0
    try:
        out = fs.create(path, replace)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        return False  # another writer was first
    out.write(bytearray(attempt.encode()))
    out.close()
    return True


def read_batches(spark: SparkSession, table: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all committed batches."""
    folders = [f"{table}/{ATTEMPTS}/{a}" for a in committed(spark, table).values()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folders)
