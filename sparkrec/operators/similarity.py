"""Item-item similarity from ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.operators.tiles import cosine_pairs
from sparkrec.schemas import require_columns
from sparkrec.session import stage


def top_neighbours(sims: DataFrame, k: int | None, item: str = "movieId",
                   neighbour: str = "neighborId") -> DataFrame:
    """Best ``k`` positive neighbours per item; ties -> smaller neighbour id.

    ``row_number <= k`` is planned as a ``WindowGroupLimit`` that keeps only
    ``k`` rows per item on the map side, before the shuffle.
    """
    if "sim_r" not in sims.columns:
        sims = sims.withColumn("sim_r", F.round("sim", 8))
    w = Window.partitionBy(item).orderBy(F.col("sim_r").desc(), F.col(neighbour).asc())
    ranked = sims.filter(F.col("sim") > 0).withColumn("rank", F.row_number().over(w))
    if k is not None:
        ranked = ranked.filter(F.col("rank") <= k)
    return ranked.select(item, neighbour, "sim", "rank")


def utility_matrix(ratings: DataFrame, check: bool = True) -> DataFrame:
    """The long-form user x movie matrix ``(userId, movieId, rating)``.

    A sparse constructor would silently sum duplicate (user, movie) pairs;
    here duplicates, empty input and null/NaN values are rejected (one
    aggregate) -- run the latest-wins dedup first.
    """
    from sparkrec.schemas import guard_ratings

    m = ratings.select("userId", "movieId", F.col("rating").cast("double").alias("rating"))
    if check:
        guard_ratings(m)
        dup = m.groupBy("userId", "movieId").count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError("ratings hold duplicate (userId, movieId) pairs; deduplicate first")
    return m


def build_cf_model(ratings: DataFrame, top_k: int = 100) -> dict[str, DataFrame]:
    """Utility matrix + top-k item similarity (persist with ``model_store.save_cf_model``)."""
    m = utility_matrix(ratings)
    return {"interactions": m, "similarity": item_similarity(m, top_k)}


def item_similarity(ratings: DataFrame, top_k: int | None = 100, write: bool = False) -> DataFrame:
    """Cosine over raw ratings (missing = 0), self excluded, top ``top_k`` per item.

    ``top_k=None`` (or <= 0), or at least as many as there are items, keeps the
    full positive matrix including the diagonal.
    Output ``(movieId, neighborId, sim, rank)``; with ``write`` it is written once and read back.
    """
    require_columns(ratings, ["userId", "movieId", "rating"], "ratings")
    if top_k and top_k > 0 and ratings.select("movieId").distinct().limit(top_k + 1).count() <= top_k:
        top_k = None
    k = top_k if top_k and top_k > 0 else None
    sims = cosine_pairs(ratings, "userId", "movieId", "rating", top_k=k, ranked=True, write=write) \
        .withColumnsRenamed({"i": "movieId", "j": "neighborId"})
    if "rank" in sims.columns:  # whole lists in order: nothing left to shuffle and sort
        return sims.select("movieId", "neighborId", "sim", "rank")
    if top_k is None or top_k <= 0:
        diag = (ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("_n"))
                .select("movieId", F.col("movieId").alias("neighborId"), F.lit(1.0).alias("sim"),
                        F.lit(1.0).alias("sim_r")))
        ranked = top_neighbours(sims.unionByName(diag), None)
    else:
        ranked = top_neighbours(sims, top_k)
    return stage(ranked) if write else ranked


def unknown_items(items: DataFrame, query_items: DataFrame) -> DataFrame:
    """R8 errors as rows: query ``movieId`` values absent from the model's item table."""
    return query_items.select("movieId").distinct().join(items.select("movieId"), "movieId", "left_anti")


def similar_items(similarity: DataFrame, query_items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nearest neighbours of each query item (batch of ``movieId``).

    ``cf_score`` is the cosine.  Query ids absent from the model have no rows
    here; ``unknown_items`` lists them (the reference raises for them).
    """
    q = query_items.select(F.col("movieId").alias("query_movieId")).distinct()
    others = similarity.filter("movieId <> neighborId")  # a full matrix lists the item itself
    w = Window.partitionBy("query_movieId").orderBy("place")
    return (q.join(others, q.query_movieId == others.movieId).filter(F.col("rank") <= k + 1)
            .select("query_movieId", F.col("neighborId").alias("movieId"), F.col("sim").alias("cf_score"),
                    F.col("rank").alias("place"))
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("place"))
