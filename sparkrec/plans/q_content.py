"""Queries for content features and content recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkrec.operators import clean, content, profile, tfidf
from sparkrec.plans import common
from sparkrec.plans import oracle as O
from sparkrec.plans.common import movies, r6
from sparkrec.plans.registry import query
from sparkrec.sources import fixtures


def movies_clean(spark, sf):
    return clean.clean_movies(movies(spark, sf))


GENRE_FEATURES_SQL = O.MOVIES_CLEAN + """,
gf AS (SELECT movieId, token, count(*) AS count FROM (
         SELECT movieId, unnest(string_split_regex(lower(coalesce(genres_text, '')), '\\s+')) AS token FROM mc) t
       WHERE token <> '' GROUP BY 1, 2)"""


@query("genre_features", O.with_(GENRE_FEATURES_SQL) + "SELECT movieId, token, count FROM gf")
def q_genre_features(spark, sf):
    return content.genre_features(movies_clean(spark, sf))


SIMILAR_GENRE_SQL = GENRE_FEATURES_SQL + "," + O.sim_sql("gf", "gs", 10, row="token", col="movieId", val="count")


def _shared_sql(a: str, b: str) -> str:
    return (f"array_to_string(list_sort(list_filter(list_intersect(string_split(coalesce({a}, ''), '|'), "
            f"string_split(coalesce({b}, ''), '|')), lambda g: g <> '')), '|')")


@query("similar_items_genre", O.with_(SIMILAR_GENRE_SQL) + f"""
SELECT gs.movieId AS query_movieId, gs.neighborId AS movieId, round(gs.sim, 6) AS similarity,
       CAST(gs.rank AS INTEGER) AS rank, {_shared_sql('q.genres', 'm.genres')} AS shared_genres
FROM gs JOIN mc q ON q.movieId = gs.movieId JOIN mc m ON m.movieId = gs.neighborId""")
def q_similar_items_genre(spark, sf):
    s = content.similar_by_genre(movies_clean(spark, sf), k=10)
    return s.select("query_movieId", "movieId", r6("similarity").alias("similarity"), "rank", "shared_genres")


@query("similar_items_genre_backfill", O.with_(SIMILAR_GENRE_SQL) + """,
own AS (SELECT DISTINCT movieId FROM gf),
low AS (SELECT movieId FROM mc ORDER BY movieId LIMIT 21),
pad AS (SELECT own.movieId, low.movieId AS neighborId, 0.0 AS sim,
               coalesce(n.have, 0) + row_number() OVER (PARTITION BY own.movieId ORDER BY low.movieId) AS rank
        FROM own CROSS JOIN low LEFT JOIN (SELECT movieId, count(*) AS have FROM gs GROUP BY 1) n ON n.movieId = own.movieId
        WHERE low.movieId <> own.movieId
          AND NOT EXISTS (SELECT 1 FROM gs WHERE gs.movieId = own.movieId AND gs.neighborId = low.movieId))
SELECT movieId AS query_movieId, neighborId AS movieId, round(sim, 6) AS similarity, CAST(rank AS INTEGER) AS rank
FROM (SELECT * FROM gs UNION ALL SELECT * FROM pad) t WHERE rank <= 10""")
def q_similar_items_genre_backfill(spark, sf):
    s = content.similar_by_genre(movies_clean(spark, sf), k=10, backfill=True)
    return s.select("query_movieId", "movieId", r6("similarity").alias("similarity"), "rank")


@query("genre_overlap", O.with_(SIMILAR_GENRE_SQL) + """
SELECT q.movieId AS query_movieId, count(m.movieId) AS n_recs,
  coalesce(count(*) FILTER (WHERE len(q.genres_list) > 0 AND len(list_intersect(q.genres_list, m.genres_list)) > 0)
    / nullif(least(10, count(m.movieId)), 0), 0) AS genre_overlap
FROM mc q LEFT JOIN gs ON q.movieId = gs.movieId LEFT JOIN mc m ON m.movieId = gs.neighborId GROUP BY 1""")
def q_genre_overlap(spark, sf):
    mc = movies_clean(spark, sf)
    recs = content.similar_by_genre(mc, k=10)
    return content.genre_overlap(recs, mc, k=10, queries=mc)


def title_queries(spark, sf):
    """Lookup strings derived from ``part``: ids, names, upper-cased names, unknown titles."""
    p = fixtures.table(spark, sf, "part")
    return (p.select(F.col("p_partkey").cast("string").alias("query"))
            .unionByName(p.select(F.col("p_name").alias("query")))
            .unionByName(p.select(F.upper("p_name").alias("query")))
            .unionByName(p.select(F.concat_ws(" ", "p_type", "p_name").alias("query"))))


@query("resolve_titles", O.with_(O.MOVIES) + """,
q AS (SELECT DISTINCT query FROM (
        SELECT CAST(p_partkey AS VARCHAR) AS query FROM part UNION ALL SELECT p_name FROM part
        UNION ALL SELECT upper(p_name) FROM part UNION ALL SELECT concat_ws(' ', p_type, p_name) FROM part) t),
num AS (SELECT query FROM q WHERE regexp_matches(trim(query), '^[0-9]+$')),
byid AS (SELECT query, m.movieId, CASE WHEN m.movieId IS NULL THEN 'unresolved' ELSE 'id' END AS method
         FROM num LEFT JOIN movies m ON m.movieId = TRY_CAST(trim(query) AS BIGINT)),
tq AS (SELECT query FROM q WHERE NOT regexp_matches(trim(query), '^[0-9]+$')),
ex AS (SELECT query, min(movieId) AS movieId, 'exact' AS method FROM tq JOIN movies ON title = query GROUP BY 1),
rest AS (SELECT query FROM tq WHERE query NOT IN (SELECT query FROM ex)),
ct AS (SELECT query, movieId, 'contains' AS method FROM (
         SELECT query, movieId, row_number() OVER (PARTITION BY query ORDER BY
           NOT (contains(title, '(') AND contains(title, ')')), length(title), title, movieId) AS rn
         FROM rest JOIN movies ON title IS NOT NULL AND contains(lower(title), lower(query))) t WHERE rn = 1),
un AS (SELECT query, CAST(NULL AS BIGINT) AS movieId, 'unresolved' AS method FROM rest
       WHERE query NOT IN (SELECT query FROM ct))
SELECT * FROM byid UNION ALL SELECT * FROM ex UNION ALL SELECT * FROM ct UNION ALL SELECT * FROM un""")
def q_resolve_titles(spark, sf):
    return content.resolve_titles(title_queries(spark, sf), movies(spark, sf))


@query("feature_text", O.with_(O.FEATURES) + """
SELECT movieId, title, genres, clean_title, genres_text, feature_text FROM feat""")
def q_feature_text(spark, sf):
    return tfidf.prepare_features(movies(spark, sf))


def movie_tfidf(spark, sf):
    """(weights, vocabulary) of the fixture movies, built and checkpointed once per session."""
    from sparkrec.session import stage

    return common.built(spark, ("tfidf",), sf, common.MOVIE_TABLES, lambda: tuple(
        stage(x) for x in tfidf.tfidf(tfidf.prepare_features(movies(spark, sf)))))


@query("tfidf_parts", O.with_(O.FEATURES, O.tfidf_sql("SELECT movieId AS doc, feature_text FROM feat")) + """
SELECT movieId, term, round(weight, 6) AS weight FROM weights""")
def q_tfidf_parts(spark, sf):
    w, _ = movie_tfidf(spark, sf)
    return w.select("movieId", "term", r6("weight").alias("weight"))


@query("tfidf_vocabulary", O.with_(O.FEATURES, O.tfidf_sql("SELECT movieId AS doc, feature_text FROM feat")) + """
SELECT term, df, total, round(idf, 6) AS idf FROM idf""")
def q_tfidf_vocabulary(spark, sf):
    _, v = movie_tfidf(spark, sf)
    return v.select("term", "df", "total", r6("idf").alias("idf"))


@query("tfidf_documents", O.with_(O.tfidf_sql("SELECT doc_id AS doc, text AS feature_text FROM documents", max_features=None)) + """
SELECT movieId, term, round(weight, 6) AS weight FROM weights""")
def q_tfidf_documents(spark, sf):
    w, _ = tfidf.tfidf(fixtures.documents_text(spark, sf), max_features=None)
    return w.select("movieId", "term", r6("weight").alias("weight"))


@query("similar_items_tfidf", O.with_(O.FEATURES, O.tfidf_sql("SELECT movieId AS doc, feature_text FROM feat"),
                                      O.sim_sql("weights", "ts", 10, row="term", col="movieId", val="weight")) + """
SELECT movieId AS query_movieId, neighborId AS movieId, round(sim, 6) AS content_score,
       CAST(rank AS INTEGER) AS rank FROM ts""")
def q_similar_items_tfidf(spark, sf):
    w, _ = movie_tfidf(spark, sf)
    s = tfidf.similar_by_tfidf(w, k=10)
    return s.select("query_movieId", "movieId", r6("content_score").alias("content_score"), "rank")


def train(spark, sf):
    return common.time_split(spark, sf)[0]


PROFILE_SQL = """,
cat AS (SELECT DISTINCT movieId FROM weights),""" + O.liked_sql("train", "liked", True) + """,
lk AS (SELECT *, greatest(rating - 3.0, 0.1) AS w FROM liked WHERE movieId IN (SELECT movieId FROM cat)),
den AS (SELECT userId, sum(w) AS ws FROM lk GROUP BY 1),
prof AS (SELECT lk.userId, term, sum(w * weight) / any_value(ws) AS weight
         FROM lk JOIN weights USING (movieId) JOIN den USING (userId) GROUP BY 1, 2)"""

CONTENT_BASE = [O.core_sql(), O.time_split_sql("core"), O.FEATURES,
                O.tfidf_sql("SELECT movieId AS doc, feature_text FROM feat")]


@query("user_profile", O.with_(*CONTENT_BASE) + PROFILE_SQL + """
SELECT userId, term, round(weight, 6) AS weight FROM prof""")
def q_user_profile(spark, sf):
    w, _ = movie_tfidf(spark, sf)
    p = profile.user_profiles(train(spark, sf), w)
    return p.select("userId", "term", r6("weight").alias("weight"))


CONTENT_SCORES_SQL = PROFILE_SQL + """,
pn AS (SELECT userId, sqrt(sum(weight * weight)) AS un FROM prof GROUP BY 1),
inr AS (SELECT movieId, sqrt(sum(weight * weight)) AS inn FROM weights GROUP BY 1),
csc AS (SELECT p.userId, w.movieId, sum(p.weight * w.weight) / (any_value(un) * any_value(inn)) AS score
        FROM prof p JOIN weights w USING (term) JOIN pn USING (userId) JOIN inr USING (movieId) GROUP BY 1, 2),
cun AS (SELECT * FROM csc WHERE score > 0 AND NOT EXISTS (
          SELECT 1 FROM train h WHERE h.userId = csc.userId AND h.movieId = csc.movieId))"""


@query("content_recs", O.with_(*CONTENT_BASE) + CONTENT_SCORES_SQL + "\n" + O.top_k_sql("cun", 10))
def q_content_recs(spark, sf):
    w, _ = movie_tfidf(spark, sf)
    r = profile.ranked_content(train(spark, sf), w, 10)
    return r.select("userId", "movieId", r6("score").alias("score"), "rank")


@query("content_candidates", O.with_(*CONTENT_BASE) + CONTENT_SCORES_SQL + "\n" + O.top_k_sql("cun", 500))
def q_content_candidates(spark, sf):
    w, _ = movie_tfidf(spark, sf)
    r = profile.ranked_content(train(spark, sf), w, 500)
    return r.select("userId", "movieId", r6("score").alias("score"), "rank")


@query("content_recs_pruned", O.with_(*CONTENT_BASE) + CONTENT_SCORES_SQL + "\n" + O.top_k_sql("cun", 10))
def q_content_recs_pruned(spark, sf):
    """The same lists from vector blocks of 64, so that bounds decide which blocks a user meets."""
    w, _ = movie_tfidf(spark, sf)
    r = profile.ranked_content(train(spark, sf), w, 10, item_block=64)
    return r.select("userId", "movieId", r6("score").alias("score"), "rank")
