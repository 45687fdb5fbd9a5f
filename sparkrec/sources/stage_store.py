"""Tables kept by input version (S18), jobs that resume (K1-K8) and commits of several tables at once.

Small driver-side files (a manifest, a pointer) go through the Hadoop file
system of their path, so any Spark file system will do; tables are ordinary
Parquet folders.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _file(spark: SparkSession, path: str):
    """(file system, path) of the JVM for ``path``."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file(spark, path)
    return fs.exists(jpath)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written beside its place and renamed, so readers see the old or the new one whole."""
    fs, target = _file(spark, path)
    _, part = _file(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, target):  # some file systems do not rename over a file
        fs.delete(target, False)
        if not fs.rename(part, target):
            raise OSError(f"cannot move the new {path} into place")


def read_small(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _file(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def input_version(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of path, size and modification time of every file under ``paths``.

    The listing is a Spark table whose content column is not read; the digest
    is an order-free aggregate, so no file list reaches the driver.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    h = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr([str(x) for x in row]).encode()).hexdigest()[:24]


class VersionedCache:
    """Values of a session by key; a value built from another version of its input files is made again."""

    def __init__(self):
        self.held: dict[tuple, tuple[str, object]] = {}

    def get(self, spark: SparkSession, key: tuple, paths: Sequence[str], make: Callable[[], object]):
        version = input_version(spark, paths)
        found = self.held.get(key)
        if found is None or found[0] != version:
            self.held[key] = found = (version, make())
        return found[1]


@dataclass(frozen=True)
class Stage:
    frame: DataFrame
    version: str


class StageStore:
    """Tables of a job under one folder; a finished stage has a manifest and is read instead of made again.

    A stage is named by its parameters and by the versions of the files and
    stages it comes from.  The manifest is written after the table, so a stage
    that was cut short is made anew, and a restarted job goes on behind the last
    finished one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.made: list[str] = []

    def source(self, name: str, frame: DataFrame) -> Stage:
        """An input table as it is; its version is an order-free digest of its rows (one aggregate)."""
        h = F.xxhash64(*[F.col(c) for c in sorted(frame.columns)])
        row = frame.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()
        return Stage(frame, hashlib.sha256(repr([name, sorted(frame.dtypes), *map(str, row)]).encode()).hexdigest()[:24])

    def stage(self, name: str, make: Callable[[], DataFrame], params: Sequence = (), after: Sequence[Stage] = (),
              paths: Sequence[str] = ()) -> Stage:
        spec = {"name": name, "params": list(params), "after": [s.version for s in after],
                "inputs": input_version(self.spark, paths) if paths else None}
        version = hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()[:24]
        folder = f"{self.root}/{name}-{version}"
        manifest = read_small(self.spark, f"{folder}/manifest.json")
        if manifest is None:
            frame = make()
            frame.write.mode("overwrite").parquet(f"{folder}/table")
            manifest = json.dumps({**spec, "schema": json.loads(frame.schema.json())})
            write_small(self.spark, f"{folder}/manifest.json", manifest)
            self.made.append(name)
        schema = StructType.fromJson(json.loads(manifest)["schema"])
        return Stage(self.spark.read.schema(schema).parquet(f"{folder}/table"), version)


POINTER = "current.json"


def commit_tables(spark: SparkSession, tables: dict[str, DataFrame | Callable[[str], DataFrame]], path: str) -> str:
    """Write all tables into a new version folder, then point to it; until then readers see the old version.

    A table given as a function gets the new folder, to derive itself from
    tables written before it.  Returns the version.  Old versions stay until
    ``drop_old_versions``, as readers may still hold them.
    """
    version = f"v-{uuid.uuid4().hex}"
    for name, table in tables.items():
        frame = table(f"{path}/{version}") if callable(table) else table
        frame.write.parquet(f"{path}/{version}/{name}")
    write_small(spark, f"{path}/{POINTER}", json.dumps({"version": version, "tables": list(tables)}))
    return version


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the committed version under ``path``; None if nothing was committed."""
    pointer = read_small(spark, f"{path}/{POINTER}")
    return None if pointer is None else f"{path}/{json.loads(pointer)['version']}"


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Delete the version folders that the pointer does not name; returns their number."""
    keep = current_folder(spark, path)
    fs, jpath = _file(spark, path)
    old = [s.getPath() for s in fs.listStatus(jpath) if s.getPath().getName().startswith("v-")
           and keep is not None and s.getPath().getName() != keep.rsplit("/", 1)[1]]
    for folder in old:
        fs.delete(folder, True)
    return len(old)
