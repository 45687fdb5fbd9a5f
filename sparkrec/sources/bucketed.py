"""Processed tables in buckets of a key (S4, S14), so that joins and aggregates on it need no exchange.

``save_bucketed`` writes an external bucketed table under a path; a small file
beside it keeps the layout, and ``open_bucketed`` gives any session the table
with it.  A bucket is one task in such a plan: a key that holds most rows makes
one long task, which adaptive execution cannot split as there is no exchange.  Tables with
keys over ``hot_share`` of all rows are refused, with the key named, and are
better left unbucketed.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.sources.stage_store import read_small, write_small

LAYOUT = "layout.json"
ROWS_PER_BUCKET = 2_000_000


def save_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None, hot_share: float = 0.05) -> int:
    """Write ``df`` under ``path`` in hash buckets of ``key``, sorted by it; returns the number of buckets."""
    spark = df.sparkSession
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.sum("n").alias("n"), F.max(F.struct("n", key)).alias("m")).first()
    rows = top["n"] or 0
    buckets = buckets or max(1, math.ceil(rows / ROWS_PER_BUCKET))
    if rows and buckets > 1 and top["m"]["n"] > max(hot_share * rows, ROWS_PER_BUCKET):
        raise ValueError(f"{key} {top['m'][key]} holds {top['m']['n']} of {rows} rows; such a table is better left unbucketed")
    name = f"bucketed_{uuid.uuid4().hex}"
    # one task writes a bucket's one file
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{path}/table").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    write_small(spark, f"{path}/{LAYOUT}", json.dumps({"key": key, "buckets": buckets, "columns": df.dtypes}))
    return buckets


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table under ``path`` with its buckets known to the planner."""
    found = read_small(spark, f"{path}/{LAYOUT}")
    if found is None:
        raise FileNotFoundError(f"no bucketed table under {path}")
    layout = json.loads(found)
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}` {t}" for c, t in layout["columns"])
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout['key']}`) SORTED BY (`{layout['key']}`) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{path}/table'")
    return spark.table(name)
