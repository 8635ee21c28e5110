"""SRC7 for large files: one JSON array, read by many tasks.

A file is cut into byte ranges.  Whether a range begins within a string, and how
deep in brackets, depends on all before it; so each range is first read under
the three states it may begin in (outside a string, within one, after a
backslash within one) and tells, for each, the state and the change of depth at
its end: a few numbers a range.  Chained in order they give every range its true
beginning.  Then each range is read again for its own elements: those whose
leading comma (or bracket) lies in it, each to its end, which may lie beyond.

Files are opened with ``pyarrow.fs`` by the workers, so any store that it knows
(local or shared folders, HDFS, S3, GCS) will do.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a range, and of what is read on at a time where an element goes beyond its range.
RANGE_BYTES, READ_ON = 32 << 20, 1 << 20
#: Elements that a task hands on at a time, or fewer if they have more than READ_ON bytes.
BATCH_ROWS = 1000

OUTSIDE, INSIDE, ESCAPED = range(3)
# plain stretches are taken at once, not byte by byte
_TOKEN = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},]|"', re.S)
_REST_OF_STRING = re.compile(rb'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
_BLANK = b" \t\r\n"


def _open(path: str):
    system, name = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return system.open_input_file(name)


def _uri(path: str) -> str:
    """Spark writes ``file:/x`` where URIs have ``file:///x``."""
    return re.sub(r"^(\w+):/(?!/)", r"\1:///", path)


def _tokens(data: bytes, state: int) -> Iterator[tuple[int, bytes]]:
    """(place, token) of the brackets and commas outside strings; a last token ``"`` if a string is open at the end."""
    at = 0
    if state != OUTSIDE:
        closing = _REST_OF_STRING.match(data, 1 if state == ESCAPED else 0)
        if closing is None:
            yield len(data), b'"'
            return
        at = closing.end()
    for found in _TOKEN.finditer(data, at):
        token = found.group()
        if token == b'"':  # no end of it in the data
            yield found.start(), token
            return
        if len(token) == 1:
            yield found.start(), token


def passage(data: bytes, state: int) -> tuple[int, int]:
    """(state, change of depth) at the end of data that begins in ``state``."""
    depth = 0
    for _, token in _tokens(data, state):
        if token in b"[{":
            depth += 1
        elif token in b"]}":
            depth -= 1
        elif token == b'"':
            # an odd run of backslashes at the end escapes what comes next
            tail = len(data) - len(data.rstrip(b"\\"))
            if state == ESCAPED and tail == len(data):
                tail -= 1  # the first of them is itself escaped
            return (ESCAPED if tail % 2 else INSIDE), depth
    return OUTSIDE, depth


def all_passages(data: bytes) -> list[int]:
    """``passage`` for each of the three states, in a row."""
    outside, inside = passage(data, OUTSIDE), passage(data, INSIDE)
    # only a quote or a backslash can tell whether it was escaped
    escaped = passage(data, ESCAPED) if data[:1] in b'"\\' else inside
    return [*outside, *inside, *escaped]


def elements(data: bytes, end: int, state: int, depth: int, first: bool, more) -> Iterator[tuple[int, bytes]]:
    """(place, text) of the elements at depth 1 whose leading comma is before ``end``; ``more()`` gives the bytes that follow."""
    start, at = None, 0
    if first:  # the file's beginning; a bare object is its one element
        while not data.strip(_BLANK) and (chunk := more()):
            data += chunk
        lead = len(data) - len(data.lstrip(_BLANK))
        if data[lead:lead + 1] != b"[":
            while chunk := more():
                data += chunk
            if data.strip(_BLANK):
                yield lead, data.strip(_BLANK)
            return
        at, depth, start = lead + 1, 1, lead + 1
    known = 0
    while True:
        stopped = None
        for place, token in _tokens(data[at:], state):
            place += at
            if token == b'"':
                stopped = place
                break
            if token in b"[{":
                depth += 1
            elif token in b"]}":
                depth -= 1
            if (token == b"," and depth == 1) or (depth == 0 and token == b"]"):
                if start is not None and (text := data[start:place].strip(_BLANK)):
                    yield start, text
                if depth == 0 or place >= end:
                    return
                start = place + 1
        known = len(data) if stopped is None else stopped
        if start is None and known >= end:
            return
        chunk = more()
        if not chunk:
            return
        # go on at the last open string, or behind what was read
        state = OUTSIDE if stopped is None or stopped < len(data) else state
        data, at = data + chunk, known


def _tasks(spark: SparkSession, ranges: int, size: int) -> int:
    """Tasks for so many ranges: one each while they are few, then as many as keep the cluster busy, or more for large files."""
    return max(1, min(ranges, max(64, 4 * spark.sparkContext.defaultParallelism)), size // RANGE_BYTES)


def _ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """(path, start, end, size) of every range of the files at ``path``, of which Spark reads names and sizes only."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).filter("size > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))
    rows = files.withColumn("start", F.explode(starts))
    rows = rows.select("path", "start", F.least(F.col("start") + range_bytes, "size").alias("end"), "size")
    ranges, size = rows.agg(F.count(F.lit(1)), F.sum(F.col("end") - F.col("start"))).first()
    return rows.repartition(_tasks(spark, ranges, size or 0))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The elements of the JSON arrays in the files at ``path`` (bare objects count as one), as columns of ``schema``,
    with ``file`` and ``at``, the byte where an element begins: together they give the order of the elements.

    Empty files and arrays have no element; an element that does not parse has null columns; the text after an
    array's end is ignored."""
    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                with _open(_uri(row["path"])) as f:
                    f.seek(row["start"])
                    data = f.read(row["end"] - row["start"])
                out.append(row | {"ends": all_passages(data)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                                             ("size", pa.int64()), ("ends", pa.list_(pa.int64()))]))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("text", pa.string())])
        for batch in batches:
            for row in batch.to_pylist():
                with _open(_uri(row["path"])) as f:
                    f.seek(row["start"])
                    data = f.read(row["end"] - row["start"])
                    found = elements(data, len(data), row["state"], row["depth"], row["start"] == 0, lambda: f.read(READ_ON))  # noqa: B023
                    places, texts, held = [], [], 0
                    for place, text in found:
                        places.append(row["start"] + place)
                        texts.append(text.decode("utf-8", "replace"))
                        held += len(text)
                        if held >= READ_ON or len(texts) >= BATCH_ROWS:
                            yield pa.RecordBatch.from_pydict({"file": [row["path"]] * len(texts), "at": places, "text": texts}, schema)
                            places, texts, held = [], [], 0
                    yield pa.RecordBatch.from_pydict({"file": [row["path"]] * len(texts), "at": places, "text": texts}, schema)

    ddl = "path string, start long, end long, size long, ends array<long>"
    begins, state, depth, last = [], OUTSIDE, 0, None
    told = _ranges(spark, path, range_bytes).mapInArrow(passages, ddl)
    # a few numbers a range, as ``begins`` holds too; sorted here, for Spark would run all passages once more to sample them
    for row in sorted(told.collect(), key=lambda r: (r["path"], r["start"])):
        if row["path"] != last:
            state, depth, last = OUTSIDE, 0, row["path"]
        begins.append((row["path"], row["start"], row["end"], state, depth))
        state, depth = row["ends"][2 * state], depth + row["ends"][2 * state + 1]
    ranges = spark.createDataFrame(begins, "path string, start long, end long, state int, depth long")
    tasks = _tasks(spark, len(begins), sum(end - start for _, start, end, _, _ in begins))
    texts = ranges.repartition(tasks).mapInArrow(parts, "file string, at long, text string")
    return texts.withColumn("_e", F.from_json("text", schema)).select("file", "at", "_e.*")
