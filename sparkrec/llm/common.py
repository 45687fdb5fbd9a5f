"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkrec.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory; Hadoop drops it when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex[:12]}"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to at most ``limit`` (a single larger item stands alone)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def annotate(docs: DataFrame, keep: list[str], score: Callable[[list], list], fields: str) -> DataFrame:
    """``docs`` columns ``keep`` as struct ``row``, beside ``fields`` that ``score(texts)`` returns as Arrow arrays.

    The struct keeps any column names apart from the new ones.
    """
    schema = f"row {docs.select(*keep).schema.simpleString()}, {fields}"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), *score(batch.column(1).to_pylist())], ["row", *names])

    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").alias("_text"))
    return rows.mapInArrow(run, schema)


MAX_LABELS = 1000
SAMPLE_PARTS = 64


def least_of_each(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The ``n`` rows of least ``order`` of each ``group``, in two levels: the last window of a group reads at most 64 n rows."""
    part = F.pmod(F.col(order), F.lit(SAMPLE_PARTS))
    first = Window.partitionBy(group, part).orderBy(order)
    last = Window.partitionBy(group).orderBy(order)
    rows = rows.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= n)
    return rows.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") <= n).drop("_n")


def sample_by_hash(rows: DataFrame, group: str, per_group: int, max_chars: int, max_groups: int = MAX_LABELS) -> DataFrame:
    """At most ``per_group`` distinct texts of each ``group`` value, those of smallest hash, as (g, text).

    Texts over ``max_chars`` are not eligible and only the ``max_groups`` most
    frequent group values are learned, so the sample's bytes are bounded.  The
    cut hash of each group is found on hashes alone and broadcast (a row per
    label); texts are read once more to fetch the sample and never shuffled.
    """
    rows = (rows.filter(F.col(group).isNotNull() & F.col("text").isNotNull() & (F.length("text") <= max_chars))
            .select(F.col(group).alias("g"), "text", F.xxhash64("text").alias("h")))
    cut = least_of_each(rows.select("g", "h").distinct(), "g", "h", per_group).groupBy("g").agg(F.max("h").alias("cut"))
    frequent = rows.groupBy("g").count().orderBy(F.col("count").desc(), "g").limit(max_groups).select("g")
    cut = cut.join(F.broadcast(frequent), "g")
    return rows.join(F.broadcast(cut), "g").filter("h <= cut").groupBy("g", "h").agg(F.min("text").alias("text")).select("g", "text")


HOT = 4096
HOT_LEAST = 256


def join_by_size(rows: DataFrame, keyed: DataFrame, key: str | list[str], size: str) -> DataFrame:
    """``rows`` joined with ``keyed`` (a row per key, with the number of its rows in ``size``).

    Keys with over 1 of ``HOT`` rows are fewer than ``HOT``: they are broadcast, so
    no task gets all rows of a hot key; the others are joined.
    """
    keys = [key] if isinstance(key, str) else key
    total = keyed.agg(F.sum(size).alias("n")).first()["n"] or 0
    is_hot = F.col(size) > total // HOT + HOT_LEAST
    hot = F.broadcast(keyed.filter(is_hot))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(keyed.filter(~is_hot), keys)
    return rows.join(hot, keys).unionByName(rest)


def by_group(rows: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table], schema) -> DataFrame:
    """``fn`` over the rows of each group, as ``applyInArrow`` does, for groups so small that their number matters.

    Rows are sorted by ``keys`` (not null) and stream through a task, which holds
    one batch and the group that it ends in.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [batch.column(key).to_numpy(zero_copy_only=False) for key in keys]
            cut = np.zeros(batch.num_rows, bool)
            for v in values:
                cut[1:] |= v[1:] != v[:-1]
            out = []
            if held and tuple(v[0] for v in values) != last:
                out.append(fn(pa.Table.from_batches(held)))
                held = []
            edges = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
            for a, b in zip(edges[:-2], edges[1:-1]):
                out.append(fn(pa.Table.from_batches([*held, batch.slice(a, b - a)])))
                held = []
            held.append(batch.slice(edges[-2]))
            last = tuple(v[-1] for v in values)
            yield from _batches(out)
        if held:
            yield from _batches([fn(pa.Table.from_batches(held))])

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _batches(tables: list[pa.Table]) -> list[pa.RecordBatch]:
    full = [t for t in tables if t.num_rows]
    return pa.concat_tables(full).combine_chunks().to_batches() if full else []
