"""Item-based CF recommendations for whole sets of users.

One parameterised operator covers both reference code lines:

* core (R6):      plain sum of similarity over liked items, strict liked set;
* ml (R9/R10):    sum of similarity x rating/5 over each liked item's first
                  ``neighbors`` neighbours, liked set falls back to the user's
                  5 best-rated items;
* notebook (R11): plain sum over 10 neighbours, strict liked set.

The similarity table ``(movieId, neighborId, sim, rank)`` holds at most ``k``
rows per item, so ``liked JOIN similarity`` yields at most ``k`` rows per liked
rating: the join fan-out is bounded per row, never quadratic in a group.  A
popular item (a hot join key on the liked side) is split by AQE's skew join.
Contributions and seen movies are shuffled once, by the user.  Asked users'
histories are written once before, so that Spark knows their size and sends a
small one to the similarity's tasks.  Contributions of more users than the disk
should hold are worked off in slices of users, each slice's lists written
before the next is begun.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.session import stage, staged_parts

FALLBACK_TOP = 5
USUAL_NEIGHBOURS = 100     # a model's lists, where a call names no number
ROWS_PER_TASK = 2_000_000  # contributions that a task adds up
ROWS_PER_SLICE = 1_500_000_000  # contributions that are on disk at once


def liked_items(history: DataFrame, threshold: float = 4.0, fallback: bool = False) -> DataFrame:
    """Ratings >= threshold; with ``fallback``, users with none keep their 5 best.

    The "has any liked item" flag is a per-user hash aggregate; the 5-best
    pick is a ``row_number`` window that Spark limits map-side.
    """
    h = history.select("userId", "movieId", "rating")
    liked = h.filter(F.col("rating") >= threshold)
    if not fallback:
        return liked
    has = liked.select("userId").distinct()
    rest = h.join(has, "userId", "left_anti")
    w = Window.partitionBy("userId").orderBy(F.col("rating").desc(), F.col("movieId").asc())
    best = rest.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= FALLBACK_TOP).drop("_r")
    return liked.unionByName(best)


def candidate_scores(history: DataFrame, similarity: DataFrame, users: DataFrame | None = None,
                     threshold: float = 4.0, neighbors: int | None = None,
                     weighted: bool = False, fallback: bool = False) -> DataFrame:
    """J6 + J5 + P14: ``(userId, movieId, score)`` over unseen movies with score > 0."""
    h, placed = history_of(history, users)
    liked = liked_items(h, threshold, fallback)
    contributions = contributions_of(liked, similarity, neighbors, weighted)
    seen = h.filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull()) \
        .select("userId", "movieId", F.lit(None).cast("double").alias("c"))
    if placed:
        scores = contributions.groupBy("userId", "movieId").agg(F.sum("c").alias("score")).filter(F.col("score") > 0)
        return scores.join(seen.select("userId", "movieId"), ["userId", "movieId"], "left_anti").select("userId", "movieId", "score")
    rows, keys = _by_user(contributions.unionByName(seen), liked, neighbors or USUAL_NEIGHBOURS)
    return (rows.groupBy(*keys, "movieId")
            .agg(F.sum("c").alias("score"), F.count_if(F.col("c").isNull()).alias("_seen"))
            .filter((F.col("_seen") == 0) & (F.col("score") > 0)).select("userId", "movieId", "score"))


def history_of(history: DataFrame, users: DataFrame | None) -> tuple[DataFrame, bool]:
    """The ratings of the asked users, and whether they lie in buckets of the user."""
    h = history.select("userId", "movieId", "rating")
    if users is not None:
        h = h.join(users.select("userId").distinct(), "userId", "left_semi")
    placed = _placed_by_user(h)
    if users is not None and not placed:
        h = stage(h)  # read three times; of few users it is small, which spares the similarity a shuffle
    return h, placed


def contributions_of(liked: DataFrame, similarity: DataFrame, neighbors: int | None, weighted: bool) -> DataFrame:
    """``(userId, movieId, c)``, what each liked rating adds to the score of each of its neighbours."""
    sim = similarity
    if neighbors is not None:
        sim = sim.filter(F.col("rank") <= neighbors)
    sim = sim.select(F.col("movieId").alias("_src"), F.col("neighborId").alias("movieId"), "sim")
    contrib = F.col("sim") * (F.col("rating") / 5.0) if weighted else F.col("sim")
    return (liked.join(sim, liked.movieId == sim._src)
            .select("userId", sim.movieId, contrib.alias("c"))
            .filter(F.col("c") > 0))


def in_user_slices(history: DataFrame, users: DataFrame | None, threshold: float, neighbors: int | None, fallback: bool,
                   finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``finish(history)`` of all users; if their contributions exceed ``ROWS_PER_SLICE``, slice by slice of users.

    ``finish`` works on each user by itself.  A slice's rows are written, and
    its shuffle files deleted, before the next slice is begun.
    """
    h = history.select("userId", "rating")
    if users is not None:
        h = h.join(users.select("userId").distinct(), "userId", "left_semi")
    best = F.approx_count_distinct("userId") * FALLBACK_TOP if fallback else F.lit(0)
    liked = h.agg((F.count_if(F.col("rating") >= threshold) + best).alias("n")).first()["n"]
    slices = -(-liked * (neighbors or USUAL_NEIGHBOURS) // ROWS_PER_SLICE)
    if slices <= 1:
        return finish(history)
    return staged_parts(slices, lambda part: finish(history.filter(F.pmod(F.xxhash64("userId"), F.lit(slices)) == part)))


def _placed_by_user(history: DataFrame) -> bool:
    """Whether ``history`` lies in buckets of the user: what joins and sums of a user need is in one task without a shuffle."""
    plan = history.groupBy("userId").agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    return "Bucketed: true" in plan and "Exchange" not in plan


def _by_user(rows: DataFrame, liked: DataFrame, neighbours: int) -> tuple[DataFrame, list[str]]:
    """``rows (userId, movieId, c)`` shuffled into tasks of bounded size, and the keys that they are shuffled by.

    By the user, so that sums, seen movies, lists and counts of a user need
    one shuffle together.  The rows of users that would fill tasks alone are
    dealt by movie as well.
    """
    each = liked.groupBy("userId").agg((F.count(F.lit(1)) * neighbours).alias("n"))
    total = each.agg(F.sum("n"), F.max("n")).first()
    spark = rows.sparkSession
    tasks = [max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total[0] // ROWS_PER_TASK))] \
        if (total[0] or 0) > ROWS_PER_TASK * spark.sparkContext.defaultParallelism else []  # else AQE sizes the tasks
    if (total[1] or 0) <= ROWS_PER_TASK:
        return rows.repartition(*tasks, "userId"), ["userId"]
    heavy = each.filter(F.col("n") > ROWS_PER_TASK).select("userId", F.ceil(F.col("n") / ROWS_PER_TASK).alias("_salts"))
    salted = rows.join(heavy, "userId", "left").withColumn(
        "_salt", F.pmod(F.xxhash64("movieId"), F.coalesce("_salts", F.lit(1).cast("long"))))
    keys = ["userId", "_salt"]
    return salted.select(*keys, "movieId", "c").repartition(*tasks, *keys), keys


def top_k_per_user(scores: DataFrame, k: int, score: str = "score") -> DataFrame:
    """Best ``k`` per user by (score rounded to 8 dp desc, movieId asc) -> ``rank``."""
    if k <= 0:
        raise ValueError("k must be greater than 0")
    w = Window.partitionBy("userId").orderBy(F.round(score, 8).desc(), F.col("movieId").asc())
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def recommend(history: DataFrame, similarity: DataFrame, users: DataFrame | None = None,
              k: int = 10, threshold: float = 4.0, neighbors: int | None = None,
              weighted: bool = False, fallback: bool = False) -> DataFrame:
    """Top-``k`` unseen movies per user -> ``(userId, movieId, score, rank)``.

    True top-k by score (the reference's first-k-by-id selection, D1, is not copied).
    """
    def lists(h: DataFrame) -> DataFrame:
        s = candidate_scores(h, similarity, users, threshold, neighbors, weighted, fallback)
        return top_k_per_user(s, k).select("userId", "movieId", "score", "rank")

    return in_user_slices(history, users, threshold, neighbors, fallback, lists)


def recommend_status(history: DataFrame, similarity: DataFrame, users: DataFrame,
                     threshold: float = 4.0, counts: DataFrame | None = None) -> DataFrame:
    """R6 errors as rows: ``ok / unknown_user / no_liked / no_candidates`` per requested user.

    ``counts``: ``n_candidates`` of each user that has any, if a caller has them already.
    """
    u = users.select("userId").distinct()
    per_user = history.groupBy("userId").agg(
        F.count_if(F.col("rating") >= threshold).alias("n_liked"))
    if counts is None:
        counts = in_user_slices(history, u, threshold, None, False, lambda h: candidate_scores(
            h, similarity, u, threshold).groupBy("userId").agg(F.count(F.lit(1)).alias("n_candidates")))
    j = u.join(per_user, "userId", "left").join(counts, "userId", "left")
    status = (F.when(F.col("n_liked").isNull(), "unknown_user")
              .when(F.col("n_liked") == 0, "no_liked")
              .when(F.coalesce(F.col("n_candidates"), F.lit(0)) == 0, "no_candidates")
              .otherwise("ok"))
    return j.select("userId", status.alias("status"),
                    F.coalesce(F.col("n_candidates"), F.lit(0)).alias("n_candidates"))
