"""Sources and sinks (SRC1-SRC7, SNK1-SNK4)."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import create_statements


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table ``{sf_dir}/{name}.parquet``; ``columns`` prunes the scan.

    How a scan is split is the session's business (``spark.sql.files.*``)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt evenly to tasks.  For narrow tables whose rows take long: a scan is split by bytes, and
    a million rows of a few compressed megabytes would be one task's."""
    return df.hint("rebalance")


def union_splits(frames: dict[str, DataFrame], split_col: str = "split") -> DataFrame:
    """SRC1/SET1: bag union of named splits (``train+test``), tagged by split,
    with ``split_ord`` keeping the split order for ordinal-based operators."""
    out = None
    for i, (name, df) in enumerate(frames.items()):
        tagged = df.withColumn(split_col, F.lit(name)).withColumn("split_ord", F.lit(i))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def decoded_path(path: Column) -> Column:
    """File paths come percent-encoded; a plus sign stands for itself in them."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


#: Sub-folders that files of many keys are spread over.
SHARDS = 64
#: Files that a task hands on at a time, or fewer if they have so many bytes.
FILES_AT_ONCE, BYTES_AT_ONCE = 1000, 8 << 20


def local_path(path: str) -> str | None:
    """The plain path of a local or mounted folder, None for other stores.

    Hadoop's local file system starts a process for each file and folder that it makes (chmod), which takes a
    hundred times the writing of a short file; there tasks make, list and read many small files themselves."""
    found = re.fullmatch(r"(?:file:(?://)?)?(/.*)", path)
    return found and found.group(1)


def _folder_name(key: str, value: str | None) -> str:
    """``key=value`` as Spark names partition folders."""
    escaped = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda c: f"%{ord(c.group()):02X}", value or "__HIVE_DEFAULT_PARTITION__")
    return f"{key}={escaped}"


def _file_writer(root: str, key: str):
    """Writes rows (shard, key, value), in order, to a file for each key.

    A file gets its name when it is whole, so that an attempt which dies or runs beside another does no harm."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, out, files = None, None, 0

        def end() -> int:
            if out is None:
                return 0
            out.close()
            os.replace(out.name, os.path.join(os.path.dirname(out.name), "part-0.txt"))
            return 1

        for batch in batches:
            for shard, value, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (shard, value) != last:
                    files += end()
                    last, folder = (shard, value), os.path.join(root, f"shard={shard}", _folder_name(key, value))
                    os.makedirs(folder, exist_ok=True)
                    out = open(os.path.join(folder, f".{uuid.uuid4().hex}"), "wb")  # noqa: SIM115
                out.write((text or b"") + b"\n")
        files += end()
        yield pa.RecordBatch.from_pydict({"files": [files]}, pa.schema([("files", pa.int64())]))

    return write


def write_by_key(df: DataFrame, path: str, key: str, shards: int = SHARDS) -> None:
    """``<path>/shard=<s>/<key>=<k>/part-*``: the rows' other column as text files, one for each key, written by the
    executors; a key's shard follows from its hash."""
    rows = df.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards))).repartition(shards, "shard")
    root = local_path(path)
    if root is None:
        rows.write.partitionBy("shard", key).mode("overwrite").text(path)
        return
    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    fs.delete(hadoop, True)
    fs.mkdirs(hadoop)
    (value,) = [c for c in df.columns if c != key]
    rows = rows.select("shard", F.nullif(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(value).cast("binary").alias("value"))
    rows.sortWithinPartitions("shard", "key").mapInArrow(_file_writer(root, key), "files long").agg(F.sum("files")).collect()


def _files_under(folder: str) -> Iterator[os.DirEntry]:
    """The files that Spark would read from a folder and those in it: neither hidden nor empty."""
    with os.scandir(folder) as entries:
        for entry in entries:
            if entry.name.startswith(".") or (entry.name.startswith("_") and "=" not in entry.name):
                continue
            if entry.is_dir():
                yield from _files_under(entry.path)
            elif entry.stat().st_size:
                yield entry


def _local_files(spark: SparkSession, folders: Sequence[str], suffix: str = "", content: bool = False) -> DataFrame:
    """(path, content) of the files in local folders, each folder listed, and its files read if asked for, by a task:
    no file's name passes the driver."""
    roots = [local_path(f) for f in folders]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("content", pa.binary())])
        paths, texts, held = [], [], 0
        for batch in batches:
            for i in batch.column(0).to_pylist():
                for entry in _files_under(roots[i]):
                    if not entry.name.endswith(suffix):
                        continue
                    text = None
                    if content:
                        with open(entry.path, "rb") as f:
                            text = f.read()
                        held += len(text)
                    paths.append(entry.path)
                    texts.append(text)
                    if len(paths) >= FILES_AT_ONCE or held >= BYTES_AT_ONCE:
                        yield pa.RecordBatch.from_pydict({"path": paths, "content": texts}, schema)
                        paths, texts, held = [], [], 0
        yield pa.RecordBatch.from_pydict({"path": paths, "content": texts}, schema)

    return spark.range(0, len(roots), 1, len(roots)).mapInArrow(run, "path string, content binary")


def _all_local(paths: str | Sequence[str]) -> bool:
    return not isinstance(paths, str) and all(map(local_path, paths))


def shard_folders(spark: SparkSession, path: str) -> list[str]:
    """The sub-folders of ``path``: one listing, whatever they hold."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    return sorted(s.getPath().toString() for s in found if s.isDirectory() and not s.getPath().getName().startswith("_"))


def read_text_tree(spark: SparkSession, paths: str | Sequence[str], key_regex: str) -> DataFrame:
    """SRC4: whole text files keyed by a regex group of their (decoded) path.

    ``paths`` is a glob, or folders that are searched through: Spark lists more
    than a few (``spark.sql.sources.parallelPartitionDiscovery.threshold``) in
    tasks, one a folder.  Local folders are listed and read by the same task.
    """
    if _all_local(paths):
        files = _local_files(spark, paths, content=True)
        return files.select(F.regexp_extract("path", key_regex, 1).alias("key"), F.col("content").cast("string").alias("text"))
    reader = spark.read if isinstance(paths, str) else spark.read.option("recursiveFileLookup", "true")
    df = reader.text(paths, wholetext=True)
    return df.select(F.regexp_extract(decoded_path(F.col("_metadata.file_path")), key_regex, 1).alias("key"),
                     F.col("value").alias("text"))


def schema_corpus(files: DataFrame, key_col: str = "db_id", text_col: str = "schema_sql") -> DataFrame:
    """FN15 + FLT11: (db_id, ddl) with only the CREATE statements; files
    without any CREATE statement are dropped."""
    return (files.select(F.col(key_col).alias("db_id"), create_statements(F.col(text_col)).alias("ddl"))
            .filter(F.col("ddl") != ""))


def available_keys_from_files(spark: SparkSession, root: str | Sequence[str], suffix: str, key_regex: str | None = None) -> DataFrame:
    """SRC5: keys ``k`` that have an artefact ``<root>/k/k<suffix>`` or, with
    ``key_regex``, a file whose path it matches; ``root`` may be many folders, which
    are then searched through and listed in tasks, as in ``read_text_tree``.

    Only the path column of the binary-file source is read (content pruned).
    """
    reader, path = spark.read.format("binaryFile"), decoded_path(F.col("path"))
    if isinstance(root, str):
        files = reader.load(f"{root.rstrip('/')}/*/*{suffix}")
    elif _all_local(root):
        files = _local_files(spark, root, suffix)
    else:
        files = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(list(root))
    esc = suffix.replace(".", r"\.")
    k = F.regexp_extract(path, key_regex, 1) if key_regex else F.regexp_extract(path, rf"([^/]+)/\1{esc}$", 1)
    return files.select("path").select(k.alias("db_id")).filter(F.col("db_id") != "").distinct()


def read_prompt_records(df: DataFrame, raw_col: str = "prompt") -> DataFrame:
    """SRC6: JSON prompt cell parsed into a struct; text that is not one JSON
    object is wrapped as a single user message."""
    from ..functions.jsonfns import guarded_from_json
    schema = ("prompt array<struct<role:string,content:string>>, env_class string, "
              "reward_spec struct<ground_truth:string,style:string>, "
              "extra_info struct<db_id:string,question:string,split:string>")
    # parsed in a column of its own, which the optimizer keeps: every use of the
    # expression itself would parse again
    df = df.withColumn("_parsed", guarded_from_json(F.col(raw_col), schema))
    parsed, messages = F.col("_parsed"), "array<struct<role:string,content:string>>"
    wrapped = F.array(F.struct(F.lit("user").alias("role"), F.col(raw_col).alias("content")))
    # a record without messages has an empty list of them
    prompt = F.when(parsed.isNull(), wrapped).otherwise(F.coalesce(parsed["prompt"], F.array().cast(messages)))
    record = F.struct(prompt.alias("prompt"), *(parsed[c].alias(c) for c in ("env_class", "reward_spec", "extra_info")))
    return df.withColumn("record", record).drop("_parsed")


def read_scoring_batches(spark: SparkSession, path: str, schema, whole_files: bool = True) -> DataFrame:
    """SRC7: JSON batches, each one object or an array of them; a batch is a
    whole file or, with ``whole_files`` off, a line."""
    return spark.read.schema(schema).option("multiLine", str(whole_files).lower()).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK1 (and SET4 with ``mode='append'``): JSON Lines part-files."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_prompt_parquet(df: DataFrame, path: str, prompt_col: str = "prompt") -> None:
    """SNK2: Parquet with exactly one STRING column ``prompt``."""
    df.select(F.col(prompt_col).cast("string").alias("prompt")).write.mode("overwrite").parquet(path)


def observe_counts(df: DataFrame, name: str, reason_col: str, reasons: Sequence[str]) -> tuple[DataFrame, Observation]:
    """SNK3: per-reason counters gathered in the same pass as the write."""
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")] + [
        F.sum(F.when(F.col(reason_col) == r, 1).otherwise(0)).alias(r) for r in reasons]
    return df.observe(obs, *aggs), obs


def warn_if_empty(obs: Observation, kept_key: str = "converted") -> str | None:
    """SNK4: message when nothing was kept (checked after the write)."""
    got = obs.get
    if not got or int(got.get(kept_key) or 0) == 0:
        return "WARNING: 0 rows written; no input row passed the filters"
    return None


def preview_first(df: DataFrame, order_col: str, chars: int = 2000) -> DataFrame:
    """LIM7: the first record (by ``order_col``) as JSON text, cut to ``chars``."""
    return df.orderBy(order_col).limit(1).select(F.left(F.to_json(F.struct(*df.columns)), F.lit(chars)).alias("preview"))


def register_views(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> None:
    """Register parquet tables as temporary views, so ad-hoc SELECTs (the
    text-to-SQL shapes: joins, grouping, IN/EXISTS, set operations, LIKE)
    run with ``spark.sql`` through Catalyst like any DataFrame query."""
    for n in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet").createOrReplaceTempView(n)
