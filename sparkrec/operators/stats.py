"""Non-personalised ranking: movie stats, weighted rating (A1-A4, R1), popularity (A5, R2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.schemas import require_columns


def movie_stats(ratings: DataFrame, m_quantile: float = 0.80) -> DataFrame:
    """A1-A4: per movie the mean, the number of ratings and the weighted rating, with ``m`` and ``C``.

    Ratings are read once: the overall mean and the quantile of the counts are
    scalar subqueries over the checkpointed per-movie table.  Null ratings
    count nowhere; without any rating there is nothing to rank (an error).
    """
    from sparkrec.session import cut_lineage

    per_movie = cut_lineage(ratings.groupBy("movieId").agg(
        F.sum("rating").alias("total"), F.avg("rating").alias("avg_rating"), F.count("rating").alias("num_ratings")))
    if per_movie.filter(F.col("num_ratings") > 0).isEmpty():
        raise ValueError("no rating to compute movie statistics from")
    c = per_movie.select(F.sum("total") / F.sum("num_ratings")).scalar()
    m = per_movie.select(F.percentile(F.col("num_ratings").cast("double"), m_quantile)).scalar()
    v, r = F.col("num_ratings"), F.col("avg_rating")
    wr = (v / (v + m)) * r + (m / (v + m)) * c
    return per_movie.select("movieId", "avg_rating", "num_ratings",
                            wr.alias("weighted_rating"), m.alias("m"), c.alias("C"))


def top_movies(movies: DataFrame, stats: DataFrame, top_k: int = 10,
               genre: str | None = None) -> DataFrame:
    """Top-K by weighted rating among movies with num_ratings >= m.

    Genre filter (case-insensitive substring) applies before the m rule.  When
    no movie reaches m, every movie is ranked (reference fallback); the
    "anyone qualified" flag is an ``exists`` scalar subquery, not a global window.
    Ranking: weighted_rating desc, num_ratings desc, movieId asc -> TakeOrderedAndProject.
    """
    df = stats.join(movies.select("movieId", "title", "genres"), "movieId")
    if genre:
        df = df.filter(F.lower(F.coalesce(F.col("genres"), F.lit(""))).contains(genre.lower()))
    qualified = F.col("num_ratings") >= F.col("m")
    anyone = df.filter(qualified).exists()
    df = df.filter(qualified | ~anyone)
    return (
        df.orderBy(F.round("weighted_rating", 8).desc(), F.col("num_ratings").desc(),
                   F.col("movieId").asc())
        .limit(top_k)
        .select("movieId", "title", "genres", "avg_rating", "num_ratings", "weighted_rating")
    )


def popular_ranking(train: DataFrame, positive_threshold: float = 4.0) -> DataFrame:
    """A5 + J2: rating_count (rows), average_rating, positive_count in one aggregate."""
    require_columns(train, ["userId", "movieId", "rating"], "train ratings")
    if not 0 <= positive_threshold <= 5:
        raise ValueError("positive_threshold must be within [0, 5]")
    return train.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("rating_count"),
        F.avg("rating").alias("average_rating"),
        F.count_if(F.col("rating") >= positive_threshold).alias("positive_count"),
    )


def popularity_order() -> list[Column]:
    """T2 with a movieId tie-break."""
    return [F.col("positive_count").desc(), F.col("average_rating").desc(),
            F.col("rating_count").desc(), F.col("movieId").asc()]


def ranked_popularity(ranking: DataFrame) -> DataFrame:
    """Attach the shared popularity rank (1 = most popular) without a one-task window.

    ``orderBy`` range-partitions and sorts in parallel; each row's rank is its
    position inside its sorted partition plus the row count of all earlier
    partitions (the per-partition counts are one row per partition).  The
    sorted frame is checkpointed so both uses see the same partitioning.
    """
    from sparkrec.session import cut_lineage

    ordered = cut_lineage(
        ranking.orderBy(*popularity_order())
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id()))
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_p0"))
    offsets = counts.select(
        "_pid", "_p0",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (ordered.join(F.broadcast(offsets), "_pid")
            .select(*ranking.columns,
                    (F.col("_off") + F.col("_pos") - F.col("_p0") + 1).cast("long").alias("pop_rank")))


RANK_CHUNK = 1024
CHUNK_USERS = 1024  # users that share a copy of a chunk: as many as it has movies


def popular_recs(users: DataFrame, train: DataFrame, ranked: DataFrame, top_k: int = 10) -> DataFrame:
    """R2: for each user, the first ``top_k`` unseen movies of the shared ranking.

    A user who has seen ``s`` movies needs at most ranks ``1 .. top_k + s``, so
    the candidate work per user is linear in that user's own history and never
    pairs users with the whole catalog.  The ranking is packed in chunks of
    ``RANK_CHUNK`` movies.  Every user needs the first chunk, fewer each next
    one: a chunk is copied once per ``CHUNK_USERS`` users that reach it.  Seen pairs go
    through an anti join and ``row_number`` per user (with a map-side group
    limit) keeps the first ``top_k``.  ``ranked`` comes from ``ranked_popularity``.
    """
    if top_k <= 0:
        raise ValueError("top_k must be greater than 0")
    u = users.select("userId").distinct()
    seen = train.select("userId", "movieId").join(u, "userId", "left_semi").distinct()
    depth = (u.join(seen.groupBy("userId").agg(F.count(F.lit(1)).alias("s")), "userId", "left")
             .select("userId", (F.lit(top_k) + F.coalesce(F.col("s"), F.lit(0))).alias("depth")))
    reached = depth.select("userId", "depth", F.explode(
        F.sequence(F.lit(0), F.floor((F.col("depth") - 1) / RANK_CHUNK).cast("int"))).alias("c"))
    salts = reached.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / CHUNK_USERS).alias("salts"))
    wanted = reached.join(salts, "c").select("userId", "depth", "c", F.pmod(F.xxhash64("userId"), F.col("salts")).alias("salt"))
    packed = ranked.groupBy(F.floor((F.col("pop_rank") - 1) / RANK_CHUNK).cast("int").alias("c")).agg(
        F.array_sort(F.collect_list(F.struct("pop_rank", "movieId"))).alias("movies"))
    packed = packed.join(salts, "c").select("c", "movies", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    part = F.slice("movies", F.lit(1), F.least(F.lit(RANK_CHUNK), F.col("depth") - F.col("c") * RANK_CHUNK).cast("int"))
    cand = wanted.join(packed, ["c", "salt"]).select("userId", F.explode(part).alias("m")) \
        .select("userId", "m.pop_rank", "m.movieId")
    cand = cand.join(seen, ["userId", "movieId"], "left_anti")
    w = Window.partitionBy("userId").orderBy("pop_rank")
    return (cand.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= top_k)
            .select("userId", "movieId", "rank"))
