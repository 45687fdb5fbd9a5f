"""Queries for exploration tables, data checks and the model store (A14-A20, J11, J14, P18, P22,
P23, E20, E21, S6, S9-S13)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkrec.operators import clean, eda, similarity, sketches, stats
from sparkrec.operators.tiles import cosine_of
from sparkrec.plans import common
from sparkrec.plans import oracle as O
from sparkrec.plans.common import core_ratings, movies, r6, ratings
from sparkrec.plans.q_content import movie_tfidf
from sparkrec.plans.q_rank import POP_SQL
from sparkrec.plans.registry import query
from sparkrec.session import ensure_checkpoint_dir
from sparkrec.sources import io, model_store


@query("eda_sparsity", O.with_(O.RATINGS) + """
SELECT count(DISTINCT userId) AS n_users, count(DISTINCT movieId) AS n_movies, count(*) AS n_ratings,
  round(count(*) / (count(DISTINCT userId) * count(DISTINCT movieId)), 6) AS density,
  round(1 - count(*) / (count(DISTINCT userId) * count(DISTINCT movieId)), 6) AS sparsity FROM ratings""")
def q_eda_sparsity(spark, sf):
    s = eda.sparsity(ratings(spark, sf))
    return s.select("n_users", "n_movies", "n_ratings", r6("density").alias("density"),
                    r6("sparsity").alias("sparsity"))


@query("eda_rating_hist", O.with_(O.RATINGS) + """
SELECT rating, count(*) AS n, round(count(*) / (SELECT count(*) FROM ratings), 6) AS share
FROM ratings GROUP BY rating""")
def q_eda_rating_hist(spark, sf):
    h = eda.rating_histogram(ratings(spark, sf))
    return h.select("rating", "n", r6("share").alias("share"))


def _quant_sql(key: str, name: str) -> str:
    return f"""SELECT '{name}' AS entity, count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
  min(n) AS min, max(n) AS max, round(quantile_cont(n, 0.25), 6) AS q25, round(quantile_cont(n, 0.5), 6) AS q50,
  round(quantile_cont(n, 0.75), 6) AS q75, round(quantile_cont(n, 0.9), 6) AS q90,
  round(quantile_cont(n, 0.99), 6) AS q99 FROM (SELECT {key}, count(*) AS n FROM ratings GROUP BY 1) t"""


@query("eda_activity_quantiles", O.with_(O.RATINGS) + _quant_sql("userId", "user") + "\nUNION ALL\n" +
       _quant_sql("movieId", "movie"))
def q_eda_activity_quantiles(spark, sf):
    r = ratings(spark, sf)
    parts = [eda.activity_quantiles(r, key).select(F.lit(name).alias("entity"), "*")
             for key, name in (("userId", "user"), ("movieId", "movie"))]
    out = parts[0].unionByName(parts[1])
    return out.select("entity", "count", *[r6(c).alias(c) for c in ("mean", "std")], "min", "max",
                      *[r6(c).alias(c) for c in ("q25", "q50", "q75", "q90", "q99")])


@query("eda_activity_hist", O.with_(O.RATINGS) + """,
per AS (SELECT userId, count(*) AS n FROM ratings GROUP BY 1),
lh AS (SELECT min(n) AS lo, max(n) AS hi FROM per)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((n - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bin,
       count(*) AS n_keys FROM per, lh GROUP BY 1""")
def q_eda_activity_hist(spark, sf):
    return eda.activity_histogram(ratings(spark, sf), "userId", 50)


@query("fk_orphans", O.with_(O.RATINGS, O.MOVIES) + """
SELECT movieId, userId, rating, ts AS "timestamp" FROM ratings WHERE movieId NOT IN (SELECT movieId FROM movies)""")
def q_fk_orphans(spark, sf):
    return eda.fk_orphans(ratings(spark, sf), movies(spark, sf))


@query("genre_coverage_top100", O.with_(O.RATINGS + POP_SQL, O.MOVIES_CLEAN) + """
SELECT genre, count(*) AS n_movies FROM (
  SELECT unnest(mc.genres_list) AS genre FROM pr JOIN mc USING (movieId) WHERE pop_rank <= 100) t GROUP BY 1""")
def q_genre_coverage(spark, sf):
    ranked = stats.ranked_popularity(stats.popular_ranking(ratings(spark, sf)))
    mc = clean.clean_movies(movies(spark, sf))
    return eda.genre_coverage(ranked.withColumnRenamed("pop_rank", "rank"), mc, 100)


@query("movies_profile", O.with_(O.MOVIES) + """
SELECT 'movieId' AS "column", 'bigint' AS dtype, count(*) FILTER (WHERE movieId IS NULL) AS nulls, count(*) AS rows
FROM movies UNION ALL
SELECT 'title', 'string', count(*) FILTER (WHERE title IS NULL), count(*) FROM movies UNION ALL
SELECT 'genres', 'string', count(*) FILTER (WHERE genres IS NULL), count(*) FROM movies""")
def q_movies_profile(spark, sf):
    return eda.movies_profile(movies(spark, sf))


@query("title_search", O.with_(O.MOVIES) + """
SELECT movieId, title, genres FROM movies WHERE contains(lower(title), 'widget')""")
def q_title_search(spark, sf):
    return eda.title_search(movies(spark, sf), "Widget")


@query("short_titles", O.with_(O.MOVIES) + r"""
SELECT movieId, substring(regexp_replace(title, '\s*\(\d{4}\)\s*$', ''), 1, 35) AS short_title FROM movies""")
def q_short_titles(spark, sf):
    return eda.short_titles(movies(spark, sf), 35)


@query("train_test_movies", O.with_(O.core_sql(), O.time_split_sql("core")) + """
SELECT DISTINCT movieId, movieId IN (SELECT movieId FROM train) AS in_train FROM test""")
def q_train_test_movies(spark, sf):
    train, test = common.time_split(spark, sf)
    return eda.train_test_movies(train, test)


@query("pair_similarity", O.with_(O.core_sql(), O.sim_sql("core", "ps", None)) + """,
cm AS (SELECT DISTINCT movieId FROM core),
pairs AS (SELECT a.movieId AS movieId, b.movieId AS neighborId FROM cm a JOIN cm b ON b.movieId = a.movieId + 1)
SELECT pairs.movieId, pairs.neighborId, round(coalesce(ps.sim, 0), 6) AS sim
FROM pairs LEFT JOIN ps ON ps.movieId = pairs.movieId AND ps.neighborId = pairs.neighborId""")
def q_pair_similarity(spark, sf):
    c = core_ratings(spark, sf)
    cm = c.select("movieId").distinct()
    pairs = cm.select("movieId", (F.col("movieId") + 1).alias("neighborId")) \
        .join(cm.select(F.col("movieId").alias("neighborId")), "neighborId", "left_semi")
    sims = cosine_of(pairs.select(F.col("movieId").alias("a"), F.col("neighborId").alias("b")),
                     c, "userId", "movieId", "rating").toDF("movieId", "neighborId", "sim")
    return pairs.join(sims, ["movieId", "neighborId"], "left").select(
        "movieId", "neighborId", r6(F.coalesce("sim", F.lit(0.0))).alias("sim"))


@query("cleaning_report", O.with_(O.core_sql()) + """,
st AS (SELECT 'raw' AS stage, * FROM ratings UNION ALL SELECT 'core_20_20', * FROM core)
SELECT stage, count(DISTINCT userId) AS n_users, count(DISTINCT movieId) AS n_movies, count(*) AS n_ratings,
  round(1 - count(*) / (count(DISTINCT userId) * count(DISTINCT movieId)), 6) AS sparsity,
  round(avg(rating), 6) AS mean_rating, round(100.0 * count(*) / (SELECT count(*) FROM ratings), 6) AS pct_kept
FROM st GROUP BY stage""")
def q_cleaning_report(spark, sf):
    raw = ratings(spark, sf)
    n_raw = raw.select(F.count(F.lit(1))).scalar()
    stages = raw.withColumn("stage", F.lit("raw")).unionByName(
        core_ratings(spark, sf).withColumn("stage", F.lit("core_20_20")))
    g = stages.groupBy("stage").agg(F.countDistinct("userId").alias("n_users"),
                                    F.countDistinct("movieId").alias("n_movies"),
                                    F.count(F.lit(1)).alias("n_ratings"), F.avg("rating").alias("mean_rating"))
    return g.select("stage", "n_users", "n_movies", "n_ratings",
                    r6(1 - F.col("n_ratings") / (F.col("n_users") * F.col("n_movies"))).alias("sparsity"),
                    r6("mean_rating").alias("mean_rating"),
                    r6(F.lit(100.0) * F.col("n_ratings") / n_raw).alias("pct_kept"))


@query("alias_drift", O.with_(O.RATINGS) + """
SELECT userId, movieId, rating, 'left_only' AS side FROM ratings WHERE false""")
def q_alias_drift(spark, sf):
    """S4 + S6: write ratings_cf and its alias with the processed-data sink, read both back, diff."""
    c = core_ratings(spark, sf)
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sparkrec-processed/{uuid.uuid4().hex}"
    io.save_processed(clean.clean_movies(movies(spark, sf)), c, c, out)
    cf = spark.read.parquet(f"{out}/ratings_cf.parquet")
    alias = spark.read.parquet(f"{out}/{io.ALIAS}.parquet")
    d = io.alias_drift(cf, alias)
    return d.select(F.col("userId").cast("long"), F.col("movieId").cast("long"),
                    F.col("rating").cast("double"), "side")


@query("alias_drift_found", O.with_(O.core_sql()) + """
SELECT userId, movieId, rating, 'right_only' AS side
FROM (SELECT userId, movieId, rating FROM ratings EXCEPT ALL SELECT userId, movieId, rating FROM core)""")
def q_alias_drift_found(spark, sf):
    """S6 where the tables do differ: the filtered ratings against all of them."""
    d = io.alias_drift(core_ratings(spark, sf), ratings(spark, sf))
    return d.select(F.col("userId").cast("long"), F.col("movieId").cast("long"),
                    F.col("rating").cast("double"), "side")


@query("model_metadata", O.with_(O.core_sql(), O.time_split_sql("core"), O.sim_sql("train", "sim", 100)) + """
SELECT count(DISTINCT movieId) AS n_movies, count(DISTINCT userId) AS n_users, count(*) AS n_train,
  (SELECT count(*) FROM test) AS n_test, (SELECT count(*) FROM sim) AS similarity_nnz,
  CAST(0.2 AS DOUBLE) AS test_ratio, CAST(4 AS DOUBLE) AS positive_threshold FROM train""")
def q_model_metadata(spark, sf):
    train, test = common.time_split(spark, sf)
    sim = common.train_similarity(spark, sf)
    return model_store.knn_cf_metadata(train, test, sim, 0.2, 4.0)


@query("content_model_metadata", O.with_(O.FEATURES, O.tfidf_sql("SELECT movieId AS doc, feature_text FROM feat")) + """
SELECT (SELECT count(*) FROM feat) AS n_movies, (SELECT count(*) FROM idf) AS n_features,
  (SELECT count(*) FROM weights) AS nnz, 2 AS min_df, 30000 AS max_features, '1,2' AS ngram_range""")
def q_content_model_metadata(spark, sf):
    from sparkrec.operators import tfidf

    w, v = movie_tfidf(spark, sf)
    return model_store.content_metadata(tfidf.prepare_features(movies(spark, sf)), w, v)


FINGERPRINT_SQL = """,
fp AS (SELECT count(*) AS fp_n, bit_xor(h) AS fp_xor, CAST(sum(h) AS VARCHAR) AS fp_sum
       FROM (SELECT CAST('0x' || substr(md5(CAST(movieId AS VARCHAR)), 1, 15) AS BIGINT) AS h
             FROM (SELECT DISTINCT movieId FROM core) ids) hs)"""


@query("catalog_fingerprint", O.with_(O.core_sql()) + FINGERPRINT_SQL + "SELECT * FROM fp")
def q_catalog_fingerprint(spark, sf):
    return model_store.fingerprint(core_ratings(spark, sf))


@query("model_roundtrip", O.with_(O.core_sql()) + FINGERPRINT_SQL + """
SELECT (SELECT count(DISTINCT userId) FROM core) AS n_users, (SELECT count(DISTINCT movieId) FROM core) AS n_items,
       (SELECT count(*) FROM core) AS n_ratings, fp.*, 'verified' AS status FROM fp""")
def q_model_roundtrip(spark, sf):
    """S9 + S10: write the CF model tables to the shared checkpoint folder, load and verify them."""
    c = core_ratings(spark, sf)
    sim = common.core_similarity(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sparkrec-models/{uuid.uuid4().hex}"
    model_store.save_cf_model(c, sim, path)
    tables = model_store.load_cf_model(spark, path, expected_n_ratings=c.count())
    return tables["meta"].withColumn("status", F.lit("verified"))


@query("eda_activity_sketches")
def q_activity_sketches(spark, sf):
    """A14/A17 by sketches of each rating's month, merged: estimates beside the exact figures' query ``eda_sparsity``."""
    r = ratings(spark, sf)
    month = F.date_trunc("month", F.timestamp_seconds("timestamp"))
    return sketches.figures(sketches.merged(sketches.activity_sketches(r, month)))
