"""Exploration tables: sparsity, histograms, quantiles, coverage, co-liked items.

(A14-A20, P18, P20, P22, P23, J11, J13, J14.)  All are aggregates that
combine map-side; none collects rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.functions import text
from sparkrec.operators.tiles import cosine_pairs


def sparsity(ratings: DataFrame) -> DataFrame:
    """Users, movies, rows (nnz), density and sparsity ``1 - n/(U*M)``."""
    agg = ratings.agg(F.countDistinct("userId").alias("n_users"),
                      F.countDistinct("movieId").alias("n_movies"),
                      F.count(F.lit(1)).alias("n_ratings"))
    dens = F.try_divide(F.col("n_ratings"), F.col("n_users") * F.col("n_movies"))
    return agg.select("n_users", "n_movies", "n_ratings", dens.alias("density"), (1 - dens).alias("sparsity"))


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """Count per rating value (10 half-step values) plus the share of rows."""
    total = ratings.select(F.count(F.lit(1))).scalar()
    return ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("n")) \
        .select("rating", "n", (F.col("n") / total).alias("share"))


def activity_quantiles(ratings: DataFrame, key: str) -> DataFrame:
    """Describe + exact quantiles of ratings per ``key`` (user or movie)."""
    per = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    qs = [0.25, 0.5, 0.75, 0.9, 0.99]
    return per.agg(
        F.count(F.lit(1)).alias("count"), F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"),
        F.min("n").alias("min"), F.max("n").alias("max"),
        *[F.percentile(F.col("n").cast("double"), q).alias(f"q{int(q * 100)}") for q in qs])


def activity_histogram(ratings: DataFrame, key: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of ratings per ``key`` over [min, max] (last bin closed)."""
    per = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lo = per.select(F.min("n")).scalar()
    hi = per.select(F.max("n")).scalar()
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("n") - lo) / width), F.lit(bins - 1))).cast("int")
    return per.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_keys"))


def fk_orphans(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings whose movieId is not in movies (expected: none)."""
    return ratings.join(movies.select("movieId"), "movieId", "left_anti")


def genre_coverage(ranked: DataFrame, movies_clean: DataFrame, top: int = 100) -> DataFrame:
    """Genre counts over the best ``top`` rows of a ranking with a ``rank`` column."""
    t = ranked.filter(F.col("rank") <= top).join(movies_clean.select("movieId", "genres_list"), "movieId")
    return t.select(F.explode("genres_list").alias("genre")).groupBy("genre") \
        .agg(F.count(F.lit(1)).alias("n_movies"))


def movies_profile(movies: DataFrame) -> DataFrame:
    """One row per column: name, type, null count, row count; one scan, then one row turned on its side."""
    counts = movies.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(movies.columns)])
    per_column = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"n{i}").alias("nulls"))
                           for i, (c, t) in enumerate(movies.dtypes)])
    return counts.select("rows", F.inline(per_column)).select("column", "dtype", "nulls", "rows")


def title_search(movies: DataFrame, needle: str) -> DataFrame:
    """Case-insensitive substring search on titles."""
    return movies.filter(F.lower(F.col("title")).contains(needle.lower()))


def short_titles(movies: DataFrame, width: int = 35) -> DataFrame:
    """Title without its trailing year, cut to ``width`` characters."""
    return movies.select("movieId", text.short_title(F.col("title"), width).alias("short_title"))


def user_options(ratings: DataFrame, limit: int | None = None) -> DataFrame:
    """P20: the distinct user ids, ascending; ``limit`` cuts the list for a pick list."""
    users = ratings.select("userId").distinct().orderBy("userId")
    return users if limit is None else users.limit(limit)


def train_test_movies(train: DataFrame, test: DataFrame) -> DataFrame:
    """Movies in test, flagged by whether train also has them."""
    tm = test.select("movieId").distinct()
    in_train = tm.join(train.select("movieId"), "movieId", "left_semi").withColumn("in_train", F.lit(True))
    not_train = tm.join(train.select("movieId"), "movieId", "left_anti").withColumn("in_train", F.lit(False))
    return in_train.unionByName(not_train)


def co_liked(ratings: DataFrame, k: int = 10, threshold: float = 4.0) -> DataFrame:
    """Per movie, the ``k`` movies liked by most of the same users.

    ``n_users(a, b)`` is the co-occurrence count of two movies in the liked
    set, computed by the tiled product (no per-user pair explosion); of a tile
    only each movie's ``k`` best leave it.
    """
    likes = ratings.filter(F.col("rating") >= threshold).select("userId", "movieId", F.lit(1.0).alias("one"))
    pairs = cosine_pairs(likes, "userId", "movieId", "one", top_k=k, unit=False)
    w = Window.partitionBy("query_movieId").orderBy(F.col("n_users").desc(), F.col("movieId").asc())
    return (pairs.select(F.col("i").alias("query_movieId"), F.col("j").alias("movieId"),
                         F.rint("sim").cast("long").alias("n_users"))
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
