"""Genre content model (R12, R13), title resolver (P17), shared genres (P19), genre overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.functions import text
from sparkrec.operators.backfill import fill_up
from sparkrec.operators.collapse import top_similar


def genre_features(movies_clean: DataFrame, check: bool = True) -> DataFrame:
    """Genre token counts ``(movieId, token, count)``.

    Tokens are whitespace-separated parts of ``genres_text`` lower-cased
    (``Sci-Fi`` stays one token).  Raises when no movie has any genre.
    """
    g = F.coalesce(F.col("genres_text"), F.lit(""))
    toks = movies_clean.select("movieId", F.explode(F.split(F.lower(g), r"\s+")).alias("token")) \
        .filter(F.col("token") != "")
    feats = toks.groupBy("movieId", "token").agg(F.count(F.lit(1)).alias("count"))
    if check and feats.isEmpty():
        raise ValueError("no genre vocabulary: every movie has empty genres_text")
    return feats


def similar_by_genre(movies_clean: DataFrame, k: int = 10, backfill: bool = False) -> DataFrame:
    """R13 for every movie at once: top-``k`` genre-cosine neighbours (positive, self excluded).

    Output ``(query_movieId, movieId, similarity, rank, shared_genres)``.
    The pairwise cosine runs on the tiled product over distinct genre vectors
    only, so neither a common genre nor a common genre list is one join key.
    With ``backfill``, lists of movies that have a genre are filled up with the
    smallest other ids at similarity 0 (D5).
    """
    feats = genre_features(movies_clean)
    top = top_similar(feats, "token", "movieId", "count", k).select(
        F.col("i").alias("query_movieId"), F.col("j").alias("movieId"), "sim", "rank")
    if backfill:
        own = feats.select(F.col("movieId").alias("owner")).distinct()
        top = fill_up(top.toDF("owner", "item", "score", "rank"), own, own.withColumn("item", F.col("owner")),
                      movies_clean.select(F.col("movieId").alias("item")), k).toDF("query_movieId", "movieId", "sim", "rank")
    g = movies_clean.select("movieId", "genres")
    q = g.select(F.col("movieId").alias("query_movieId"), F.col("genres").alias("query_genres"))
    return (top.join(q, "query_movieId").join(g, "movieId")
            .select("query_movieId", "movieId", F.col("sim").alias("similarity"), "rank",
                    text.shared_genres(F.col("query_genres"), F.col("genres")).alias("shared_genres")))


def items_without_genres(movies_clean: DataFrame, query_items: DataFrame | None = None) -> DataFrame:
    """R13 errors as rows: (query) movies with no genre token, which have no genre similarity."""
    m = movies_clean.filter(F.size(F.coalesce(F.col("genres_list"), F.array())) == 0).select("movieId")
    if query_items is not None:
        m = m.join(query_items.select("movieId").distinct(), "movieId", "left_semi")
    return m


def genre_overlap(recs: DataFrame, movies_clean: DataFrame, k: int = 10,
                  queries: DataFrame | None = None) -> DataFrame:
    """E8 per query movie: share of its top-``k`` recs sharing a genre (sentinel ignored).

    Denominator ``min(k, rows)``; 0 when the query movie has no genre.
    ``recs`` has (query_movieId, movieId, rank).  ``queries`` (movieId) names the
    movies that were asked for: one without any rec gets a row of 0.
    """
    if k <= 0:
        raise ValueError("k must be greater than 0")
    gl = movies_clean.select("movieId", "genres_list")
    q = gl.select(F.col("movieId").alias("query_movieId"), F.col("genres_list").alias("q_list"))
    top = recs.filter(F.col("rank") <= k).join(gl, "movieId").join(q, "query_movieId")
    per = top.groupBy("query_movieId").agg(
        F.count(F.lit(1)).alias("n_recs"),
        F.count_if(F.arrays_overlap("q_list", "genres_list") & (F.size("q_list") > 0)).alias("n_shared"))
    if queries is not None:
        asked = queries.select(F.col("movieId").alias("query_movieId")).distinct()
        per = asked.join(per, "query_movieId", "left").na.fill(0, ["n_recs", "n_shared"])
    share = F.try_divide(F.col("n_shared"), F.least(F.lit(k), F.col("n_recs")))
    return per.select("query_movieId", "n_recs", F.coalesce(share, F.lit(0.0)).alias("genre_overlap"))


def _grams(text_col: Column, n: Column) -> Column:
    """Every part of ``n`` characters of the lower-cased text; no row for a shorter one."""
    low = F.lower(text_col)
    last = F.length(low) - n + 1
    at = F.when((last > 0) & (n > 0), F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.explode(F.transform(at, lambda i: F.substring(low, i, n))).alias("gram")


def resolve_titles(queries: DataFrame, movies: DataFrame) -> DataFrame:
    """P17 for a batch of ``query`` strings -> ``(query, movieId, method)``.

    Order of passes, first hit wins: numeric string -> id (no title fallback,
    unknown id -> unresolved); exact title; case-insensitive substring, where
    titles containing both '(' and ')' are preferred, then shorter, then
    alphabetical, then smaller id.  The substring pass joins through a
    trigram index on titles: a title contains the query only if it contains
    the query's rarest trigram, which decides the candidates (ids; titles are
    joined to these alone).  A query of one or two characters is its own gram.
    """
    q = queries.select("query").distinct()
    m = movies.select("movieId", "title").filter(F.col("title").isNotNull())
    numeric = F.trim(F.col("query")).rlike(r"^[0-9]+$")
    by_id = (q.filter(numeric)
             .join(m.select(F.col("movieId").alias("_id")),
                   F.trim(F.col("query")).try_cast("long") == F.col("_id"), "left")
             .select("query", F.col("_id").alias("movieId"),
                     F.when(F.col("_id").isNull(), "unresolved").otherwise("id").alias("method")))
    text_q = q.filter(~numeric)
    exact = (text_q.join(m, text_q.query == m.title)
             .groupBy("query").agg(F.min("movieId").alias("movieId"))
             .withColumn("method", F.lit("exact")))
    rest = text_q.join(exact.select("query"), "query", "left_anti")
    wanted = rest.select("query", _grams(F.col("query"), F.least(F.length(F.lower("query")), F.lit(3)))).distinct()
    posted = m.select("movieId", F.lower("title").alias("lt")).select("movieId", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("n"), "lt")
    posted = (posted.select("movieId", _grams(F.col("lt"), F.col("n"))).distinct()
              .join(wanted.select("gram").distinct(), "gram", "left_semi"))
    rare = wanted.join(posted.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram", "left") \
        .groupBy("query").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("g"))
    cand = (rare.filter("g.n > 0").select("query", F.col("g.gram").alias("gram")).join(posted, "gram")
            .join(m, "movieId").filter(F.lower(F.col("title")).contains(F.lower(F.col("query")))))
    paren = (F.col("title").contains("(") & F.col("title").contains(")"))
    best = cand.groupBy("query").agg(F.min(F.struct(
        (~paren).alias("np"), F.length("title").alias("len"), F.col("title").alias("t"),
        F.col("movieId").alias("id"))).alias("b"))
    contains = best.select("query", F.col("b.id").alias("movieId"), F.lit("contains").alias("method"))
    unresolved = (rest.join(contains.select("query"), "query", "left_anti")
                  .select("query", F.lit(None).cast("long").alias("movieId"), F.lit("unresolved").alias("method")))
    return by_id.unionByName(exact).unionByName(contains).unionByName(unresolved)

