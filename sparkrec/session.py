"""Session helpers: building a session for tests/bench and lineage cuts."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "sparkrec") -> SparkSession:
    """Return the active session or build one.

    Master, memory and partition counts stay as submitted unless a caller
    (tests, bench) names them.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
        return active
    builder = SparkSession.builder.appName(app).config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config(
            "spark.ui.showConsoleProgress", "false")
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("SPARKREC_DRIVER_MEM", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package (a zip added once per application), wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sparkrec-ship-"), "sparkrec.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("sparkrec", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset.

    On a cluster the directory must be on shared storage, so it is read from
    the session.  Only a bare local session (tests) gets a fresh temp folder;
    on any other master a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="sparkrec-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


#: Spark's own clean-up of shuffle files at the end of an execution; off by default.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint.

    The frame is persisted first so the checkpoint's count job and its write
    job share one computation; the cache is dropped once the files exist.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def stage(df: DataFrame) -> DataFrame:
    """``df`` written once as compressed columns under the checkpoint directory and read back.

    As safe as a checkpoint and several times smaller, for large tables of numbers.
    The shuffle files that the write needed are deleted with its end, so a job
    holds those of one stage at a time.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def staged_parts(parts: int, make: Callable[[int], DataFrame]) -> DataFrame:
    """The union of ``make(0) .. make(parts - 1)``, each written before the next is begun."""
    return reduce(DataFrame.unionByName, [stage(make(part)) for part in range(parts)])


ROWS_PER_TASK = 250_000


def task_count(df: DataFrame, rows: int) -> int:
    """Tasks for ``rows`` rows of ``df``: at most ``ROWS_PER_TASK`` each, and no fewer than the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_TASK))


def spread(df: DataFrame, rows: int, *keys) -> DataFrame:
    """``df`` of ``rows`` rows shuffled by ``keys`` into tasks of bounded size; a small table is left as it is.

    Without a count, tasks hold 64 MB of compressed rows each after AQE has
    joined them, whatever they then sort or aggregate in memory.
    """
    if rows <= ROWS_PER_TASK * df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(task_count(df, rows), *keys)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder on the file system of ``path`` unless it is there."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jpath)
