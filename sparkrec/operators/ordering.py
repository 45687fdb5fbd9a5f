"""Position of each row inside its group, computed without a per-group sort task.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task.
When one user owns a third of all rows, that task does a third of the work.
Here the frame is range-sorted on (group, order) instead: range partitioning
splits a hot group over several partitions, and each row's position is its
offset inside its partition plus the group's row count in earlier partitions.
Those counts form one small row per (partition, group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.session import ROWS_PER_TASK, spread, stage, task_count


def group_position(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add ``_pos`` (0-based position in ``order`` within ``group``) and ``_n`` (group size).

    ``order`` must make the order total inside a group (end it with a unique
    key), so positions do not depend on input layout.  Rows are counted first
    (callers pass a built table), so that no task sorts more than its share.
    """
    cols = df.columns
    rows = df.count()
    keys = [*[F.col(g) for g in group], *order]
    many = rows > ROWS_PER_TASK * df.sparkSession.sparkContext.defaultParallelism
    in_order = df.repartitionByRange(task_count(df, rows), *keys).sortWithinPartitions(*keys) if many else df.orderBy(*keys)
    ordered = stage(
        in_order
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()))
    per_part = ordered.groupBy("_pid", *group).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*group).orderBy("_pid")
    offsets = per_part.select(
        "_pid", *group, "_first",
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"))
    return (spread(ordered, rows, "_pid", *group).join(offsets, ["_pid", *group])
            .select(*cols, (F.col("_off") + F.col("_mid") - F.col("_first")).alias("_pos"), "_n"))
