"""Connected components of an edge table, by least label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the least node of its component.

    Each round takes the least label among a node and its neighbours, then the
    label of that label; rounds are written to shared storage and stop when
    nothing changes.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        best = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "m").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = staged(best.join(jump, "next").select("node", F.least("next", "far").alias("new"), "label"), "labels")
        labels = new.select("node", F.col("new").alias("label"))
        if not new.filter("new <> label").limit(1).count():
            return labels
