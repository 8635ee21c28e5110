"""Session and shared-scratch helpers.

Everything that writes intermediate files (sinks, derived corpora, stream
checkpoints) puts them under the folder the cluster names in
``spark.checkpoint.dir``.  We only set that folder ourselves when the session
has none, which is the case in local tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # parquet scans: 128 MB splits keep tasks spill-free on large inputs
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "rewardlake") -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("REWARDLAKE_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    prepare(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    # unset: only a local run (tests / bench) may use a folder under /tmp; a
    # cluster must name a shared folder, executors cannot see a driver's /tmp
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="rewardlake-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared scratch area for one run."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(spark: SparkSession, df, name: str):
    """Write a derived table once to the shared checkpoint folder and read it
    back: later branches scan it (with pruning and pushdown) instead of
    recomputing its lineage, and a lost executor cannot lose it."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what ``scratch_path`` has handed out so far.  For the end of a job:
    frames that read such a table cannot be computed again afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/scratch")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_PKG_DIR = os.path.dirname(os.path.abspath(__file__))


def ship_package(spark: SparkSession) -> None:
    """Local runs: make ``rewardlake`` importable in the Python workers (Pandas
    UDFs pickle references to its functions) even when the driver imported it
    from another directory -- zip it once per SparkContext into the scratch
    folder and ``addPyFile`` it.  On a cluster the package is shipped the
    usual way (``--py-files`` / an installed wheel), so nothing happens here.
    """
    sc = spark.sparkContext
    if getattr(sc, "_rewardlake_shipped", False) or not sc.master.startswith("local"):
        return
    path = scratch_path(spark, "pyfiles") + "/rewardlake.zip"
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(local), exist_ok=True)
    root = os.path.dirname(_PKG_DIR)
    with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(_PKG_DIR):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(local)
    sc._rewardlake_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder + package shipped to the workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark
