"""Queries for cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkrec.operators import clean
from sparkrec.plans import oracle as O
from sparkrec.plans.common import core_ratings, movies, ratings
from sparkrec.plans.registry import query


@query("movies_clean", O.with_(O.MOVIES) + r"""
SELECT movieId, title, genres,
  CAST(nullif(regexp_extract(title, '\((\d{4})\)[^()]*$', 1), '') AS INTEGER) AS year,
  array_to_string(list_filter(string_split(coalesce(genres, '(no genres listed)'), '|'),
                  lambda g: g <> '' AND g <> '(no genres listed)'), '|') AS genres_list,
  array_to_string(list_filter(string_split(coalesce(genres, '(no genres listed)'), '|'),
                  lambda g: g <> '' AND g <> '(no genres listed)'), ' ') AS genres_text
FROM movies""")
def q_movies_clean(spark, sf):
    m = clean.clean_movies(movies(spark, sf))
    return m.select("movieId", "title", "genres", "year",
                    F.array_join("genres_list", "|").alias("genres_list"), "genres_text")


@query("ratings_dedup", O.with_(O.RATINGS) + """
SELECT userId, movieId, rating, ts AS "timestamp" FROM ratings""")
def q_ratings_dedup(spark, sf):
    return ratings(spark, sf)


@query("ratings_dedup_events", O.with_(O.EVENTS_RAW) + """
SELECT userId, movieId, rating, ts AS "timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY userId, movieId ORDER BY ts DESC, rating DESC, event_id) rn
  FROM ev_raw) t WHERE rn = 1 AND rating BETWEEN 0.5 AND 5.0""")
def q_ratings_dedup_events(spark, sf):
    from sparkrec.sources import fixtures
    return clean.prepare_ratings(fixtures.ratings_events(spark, sf))


@query("ratings_core_20_20", O.with_(O.RATINGS, O.activity_filter_sql("ratings", 20, 20, 10)) + """
SELECT userId, movieId, rating, ts AS "timestamp" FROM af10""")
def q_core_20_20(spark, sf):
    return core_ratings(spark, sf, 20, 20)


@query("ratings_core_20_25_cap10", O.with_(O.RATINGS, O.activity_filter_sql("ratings", 20, 25, 10)) + """
SELECT userId, movieId, rating, ts AS "timestamp" FROM af10""")
def q_core_20_25(spark, sf):
    return core_ratings(spark, sf, 20, 25, max_iter=10)


@query("ratings_core_20_25", O.with_(O.RATINGS, O.activity_filter_sql("ratings", 20, 25, 20)) + """
SELECT userId, movieId, rating, ts AS "timestamp" FROM af20""")
def q_core_20_25_fixpoint(spark, sf):
    return core_ratings(spark, sf, 20, 25)
