"""Cleaning: movie columns (P1-P3), latest-wins dedup (W1), range (P8), activity filter."""

from __future__ import annotations

import uuid
import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.functions import text
from sparkrec.schemas import require_columns
from sparkrec.session import cut_lineage, ensure_checkpoint_dir, make_folder, spread, stage, task_count

RATING_COLS = ["userId", "movieId", "rating", "timestamp"]
ROWS_PER_BUCKET = 4_000_000
MAX_BUCKETS = 4096
BUCKET_SHARES = 16  # tasks that a bucket's rows are dealt to, a hot id's too


def clean_movies(movies: DataFrame) -> DataFrame:
    """Add ``year``, ``genres_list`` and ``genres_text``; narrow, no shuffle."""
    require_columns(movies, ["movieId", "title", "genres"], "movies")
    gl = text.genres_list(F.col("genres"))
    return movies.select(
        "movieId", "title", "genres",
        text.year_from_title(F.col("title")).alias("year"),
        gl.alias("genres_list"),
        text.genres_text(gl).alias("genres_text"),
    )


def dedup_latest(ratings: DataFrame) -> DataFrame:
    """Keep the latest rating per (userId, movieId); ties -> higher rating.

    Written as a hash aggregate on ``max(struct(timestamp, rating))`` instead of
    a ``row_number`` window: the aggregate combines map-side, so a hot user or
    movie is reduced before the shuffle and no partition is fully sorted.
    Rows that tie on (timestamp, rating) are identical in the output columns,
    so the result does not depend on input order.
    """
    require_columns(ratings, RATING_COLS, "ratings")
    latest = F.max(F.struct(F.col("timestamp"), F.col("rating"))).alias("s")
    return (
        ratings.groupBy("userId", "movieId").agg(latest)
        .select("userId", "movieId", F.col("s.rating").alias("rating"),
                F.col("s.timestamp").alias("timestamp"))
    )


def valid_range(ratings: DataFrame, lo: float = 0.5, hi: float = 5.0) -> DataFrame:
    """Keep ratings in [lo, hi]; NaN fails ``<= hi`` and is dropped."""
    return ratings.filter(F.col("rating").between(lo, hi))


def prepare_ratings(raw: DataFrame) -> DataFrame:
    """W1 then P8, in the reference's order (dedup before the range check)."""
    return valid_range(dedup_latest(raw.select(*RATING_COLS)))


@dataclass
class FilterResult:
    ratings: DataFrame
    passes: int
    converged: bool
    read: list[tuple[int, int]] = field(default_factory=list)  # buckets read by movie and by user in each pass


@dataclass
class EdgeLayout:
    """(userId, movieId) rows twice on shared storage: in folders by hash of the movie, and by hash of the user.

    A pass of the activity filter reads only the folders that hold removed ids.
    """

    path: str
    buckets: int
    rows: int

    def edges(self, spark, key: str, wanted: list[int] | None = None) -> DataFrame:
        """The rows of the ``wanted`` buckets (all if None) of the layout by ``key``; other folders are not listed."""
        folders = [f"{self.path}/{key}/bucket={b}" for b in (range(self.buckets) if wanted is None else wanted)]
        return spark.read.schema("userId long, movieId long").parquet(*folders)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def edge_layout(ratings: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> EdgeLayout:
    """Write both layouts of a built ratings table; the number of buckets follows from its rows."""
    ratings = ratings.filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull())
    rows = ratings.count()
    buckets = max(1, min(MAX_BUCKETS, -(-rows // rows_per_bucket)))
    path = f"{ensure_checkpoint_dir(ratings.sparkSession).rstrip('/')}/edges-{uuid.uuid4().hex}"
    for key in ("movieId", "userId"):
        edges = ratings.select(F.col("userId").cast("long"), F.col("movieId").cast("long")).withColumn("bucket", bucket_of(key, buckets))
        share = F.pmod(F.xxhash64("userId", "movieId"), F.lit(BUCKET_SHARES))  # the writer sorts a task's rows by folder
        dealt = edges.repartition(task_count(ratings, rows), "bucket", share) if buckets > 1 else edges
        dealt.write.partitionBy("bucket").parquet(f"{path}/{key}")
        for b in range(buckets):  # a folder that got no row is still there to be read
            make_folder(ratings.sparkSession, f"{path}/{key}/bucket={b}")
    return EdgeLayout(path, buckets, rows)


def _degrees(edges: DataFrame, key: str) -> DataFrame:
    return edges.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def _peel(layout: EdgeLayout, key: str, least: int, own: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Remove ``key`` ids with fewer than ``least`` rows: (own, other) degrees without them, and the buckets read.

    Only the rows of removed ids are read, and of those, the ones whose other
    id is still there are subtracted from its degree.
    """
    spark = own.sparkSession
    far = "userId" if key == "movieId" else "movieId"
    gone = own.filter(F.col("n") < least).select(key)
    wanted = [r["b"] for r in gone.select(bucket_of(key, layout.buckets).alias("b")).distinct().collect()]  # at most MAX_BUCKETS
    if not wanted:
        return own, other, []
    lost = layout.edges(spark, key, sorted(wanted)).join(gone, key, "left_semi").groupBy(far).agg(F.count(F.lit(1)).alias("lost"))
    fewer = other.join(lost, far, "left").select(far, (F.col("n") - F.coalesce("lost", F.lit(0))).alias("n"))
    return own.filter(F.col("n") >= least), cut_lineage(fewer), sorted(wanted)


def activity_filter(ratings: DataFrame, min_user: int = 20, min_movie: int = 50,
                    max_iter: int | None = None, warn: bool = True, layout: EdgeLayout | None = None) -> FilterResult:
    """Alternate movie >= min_movie and user >= min_user filters to the fixpoint, by peeling.

    Degrees are counted once.  A pass removes the movies below the limit, reads
    the rows of those movies alone and subtracts them from their users' degrees,
    then the same with the users; so a pass costs its frontier, not all ratings.
    The ratings themselves are filtered once, at the end.  ``max_iter`` stops
    early on request; ``converged`` says whether the last pass changed nothing
    (D9).  ``layout`` may be shared by several filters of one table.
    """
    base = ratings.select(*RATING_COLS)   # callers pass a built (checkpointed) table
    spark = base.sparkSession
    layout = layout or edge_layout(base)
    movies = cut_lineage(_degrees(layout.edges(spark, "movieId"), "movieId"))
    users = cut_lineage(_degrees(layout.edges(spark, "userId"), "userId"))
    left, before, passes = layout.rows, -1, 0
    read: list[tuple[int, int]] = []
    while left != before and (max_iter is None or passes < max_iter):
        movies, users, of_movies = _peel(layout, "movieId", min_movie, movies, users)
        users, movies, of_users = _peel(layout, "userId", min_user, users, movies)
        before, left = left, users.agg(F.sum("n")).first()[0] or 0
        read.append((len(of_movies), len(of_users)))
        passes += 1
    converged = left == before
    if not converged and warn:
        warnings.warn(f"activity filter stopped after {passes} passes; rows were still being removed", stacklevel=2)
    if left == 0:
        raise ValueError(f"activity filter left no ratings (users need {min_user}, movies {min_movie})")
    if not passes:
        return FilterResult(base, passes, converged, read)
    of_users = spread(base, layout.rows, "userId").join(users.select("userId"), "userId", "left_semi")
    kept = spread(of_users, layout.rows, "movieId").join(movies.select("movieId"), "movieId", "left_semi")
    return FilterResult(stage(kept.select(*RATING_COLS)), passes, converged, read)
