"""Train/test splits: leave-last-out (E1) and per-user time split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.operators.ordering import group_position
from sparkrec.schemas import require_columns
from sparkrec.session import spread, stage

COLS = ["userId", "movieId", "rating", "timestamp"]


def leave_last_out(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each user's last rating (timestamp, then movieId) -> test, the rest -> train.

    The last key per user is a hash aggregate ``max(struct(timestamp, movieId))``
    (combined map-side, so a heavy user costs one partial row per task).  Rows
    meet it in one join on both columns, are marked and written once.
    Single-rating users end up in test only, as in the reference.
    """
    require_columns(ratings, COLS, "ratings")
    last = ratings.groupBy("userId").agg(F.max(F.struct("timestamp", "movieId")).alias("_k")) \
        .select("userId", F.col("_k.movieId").alias("movieId"))
    rows = spread(ratings.select(*COLS), ratings.count(), "userId", "movieId")  # callers pass a built table
    marked = stage(rows.join(last.withColumn("_test", F.lit(True)), ["userId", "movieId"], "left"))
    return (marked.filter(F.col("_test").isNull()).select(*COLS),
            marked.filter(F.col("_test")).select(*COLS))


def time_split(ratings: DataFrame, test_ratio: float = 0.2, min_test: int = 1
               ) -> tuple[DataFrame, DataFrame]:
    """Per user, the newest ``n_test`` ratings -> test.

    ``n_test = max(floor(n * ratio), min_test)``, capped at ``n - 1`` and at
    least 0, so single-rating users stay in train.  Order is (timestamp,
    movieId) (D4).  Positions come from ``group_position`` (skew-safe); marked
    rows are written once and both parts read from there.
    """
    require_columns(ratings, COLS, "ratings")
    if not 0 < test_ratio < 1:
        raise ValueError("test_ratio must be in (0, 1)")
    if min_test < 1:
        raise ValueError("min_test must be >= 1")
    pos = group_position(ratings.select(*COLS), ["userId"], [F.col("timestamp"), F.col("movieId")])
    n = F.col("_n")
    n_test = F.greatest(F.least(F.greatest(F.floor(n * test_ratio), F.lit(min_test)), n - 1), F.lit(0))
    flagged = stage(pos.select(*COLS, ((F.col("_pos") >= n - n_test) & (n_test > 0)).alias("_test")))
    return (flagged.filter(~F.col("_test")).select(*COLS),
            flagged.filter(F.col("_test")).select(*COLS))
