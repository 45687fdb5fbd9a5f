"""Queries for non-personalised ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkrec.operators import stats
from sparkrec.plans import oracle as O
from sparkrec.plans.common import movies, r6, ratings
from sparkrec.plans.registry import query

STATS_SQL = """,
stats AS (SELECT movieId, avg(rating) AS avg_rating, count(rating) AS num_ratings
          FROM ratings GROUP BY movieId),
cm AS (SELECT (SELECT avg(rating) FROM ratings) AS C,
              (SELECT quantile_cont(num_ratings, 0.8) FROM stats) AS m),
ms AS (SELECT movieId, avg_rating, num_ratings,
          num_ratings / (num_ratings + m) * avg_rating + m / (num_ratings + m) * C AS weighted_rating,
          m, C
       FROM stats, cm)"""


@query("movie_stats", O.with_(O.RATINGS + STATS_SQL) + """
SELECT movieId, round(avg_rating, 6) AS avg_rating, num_ratings,
       round(weighted_rating, 6) AS weighted_rating, round(m, 6) AS m, round(C, 6) AS C
FROM ms""")
def q_movie_stats(spark, sf):
    s = stats.movie_stats(ratings(spark, sf))
    return s.select("movieId", r6("avg_rating").alias("avg_rating"), "num_ratings",
                    r6("weighted_rating").alias("weighted_rating"), r6("m").alias("m"), r6("C").alias("C"))


def _top_sql(genre: str | None) -> str:
    gfilter = f"WHERE contains(lower(coalesce(genres, '')), '{genre.lower()}')" if genre else ""
    return O.with_(O.RATINGS + STATS_SQL, O.MOVIES) + f""",
j AS (SELECT ms.*, title, genres FROM ms JOIN movies USING (movieId) {gfilter}),
q AS (SELECT * FROM j WHERE num_ratings >= m OR NOT EXISTS (SELECT 1 FROM j WHERE num_ratings >= m))
SELECT movieId, title, genres, round(avg_rating, 6) AS avg_rating, num_ratings,
       round(weighted_rating, 6) AS weighted_rating
FROM q ORDER BY round(weighted_rating, 8) DESC, num_ratings DESC, movieId LIMIT 10"""


def _top(spark, sf, genre=None):
    s = stats.movie_stats(ratings(spark, sf))
    t = stats.top_movies(movies(spark, sf), s, top_k=10, genre=genre)
    return t.select("movieId", "title", "genres", r6("avg_rating").alias("avg_rating"), "num_ratings",
                    r6("weighted_rating").alias("weighted_rating"))


@query("simple_top10", _top_sql(None))
def q_simple_top10(spark, sf):
    return _top(spark, sf)


@query("simple_top10_genre", _top_sql("Widget"))
def q_simple_top10_genre(spark, sf):
    return _top(spark, sf, "Widget")


POP_SQL = """,
pop AS (SELECT movieId, count(*) AS rating_count, avg(rating) AS average_rating,
               count(*) FILTER (WHERE rating >= 4.0) AS positive_count
        FROM ratings GROUP BY movieId),
pr AS (SELECT *, row_number() OVER (ORDER BY positive_count DESC, average_rating DESC,
                                   rating_count DESC, movieId) AS pop_rank FROM pop)"""


@query("popular_ranking", O.with_(O.RATINGS + POP_SQL) + """
SELECT movieId, rating_count, round(average_rating, 6) AS average_rating, positive_count, pop_rank
FROM pr""")
def q_popular_ranking(spark, sf):
    ranked = stats.ranked_popularity(stats.popular_ranking(ratings(spark, sf)))
    return ranked.select("movieId", "rating_count", r6("average_rating").alias("average_rating"),
                         "positive_count", "pop_rank")


@query("popular_recs", O.with_(O.RATINGS + POP_SQL) + """,
seen AS (SELECT userId, count(*) AS s FROM ratings GROUP BY userId),
cand AS (SELECT seen.userId, pr.movieId, pr.pop_rank FROM seen JOIN pr ON pr.pop_rank <= 10 + seen.s
         WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.userId = seen.userId AND r.movieId = pr.movieId)),
rk AS (SELECT userId, movieId, CAST(row_number() OVER (PARTITION BY userId ORDER BY pop_rank) AS INTEGER) AS rank
       FROM cand)
SELECT userId, movieId, rank FROM rk WHERE rank <= 10""")
def q_popular_recs(spark, sf):
    r = ratings(spark, sf)
    ranked = stats.ranked_popularity(stats.popular_ranking(r))
    return stats.popular_recs(r.select("userId"), r, ranked, top_k=10)
