"""TF-IDF content features (P7, R14) and content similarity.

Definition (R14): lower-case; tokens are runs of >= 2 word characters
(letters, digits, underscore); English stop words removed *before* bigrams;
terms = unigrams + bigrams of consecutive kept tokens; raw counts; keep terms
in >= ``min_df`` documents, then the ``max_features`` largest by total count
(tie: term ascending); ``idf = ln((1 + n) / (1 + df)) + 1``; L2 row norm.
Spark ML's ``IDF`` lacks the ``+1`` and yields index vectors, so the steps
are written with built-in column functions instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.functions import stopwords, text
from sparkrec.operators.collapse import top_similar
from sparkrec.schemas import require_columns
from sparkrec.session import stage, staged_parts

CHARS_PER_TASK = 4_000_000  # of texts whose terms a task counts
CHARS_PER_SLICE = 500_000_000  # of texts whose terms are on disk at once
TOKEN = r"[\p{L}\p{N}_]{2,}"   # runs of >= 2 word characters


def prepare_features(movies: DataFrame) -> DataFrame:
    """(movieId, title, genres, clean_title, genres_text, feature_text).

    Null ids dropped; one row per movieId (the smallest (title, genres) when
    duplicated, so the choice is layout-independent); rows with empty
    ``feature_text`` dropped.
    """
    require_columns(movies, ["movieId", "title", "genres"], "movies")
    m = movies.filter(F.col("movieId").isNotNull()) \
        .groupBy(F.col("movieId").cast("long").alias("movieId")) \
        .agg(F.min(F.struct("title", "genres")).alias("_m")) \
        .select("movieId", F.col("_m.title").alias("title"), F.col("_m.genres").alias("genres"))
    title = text.strip_ws(F.coalesce(F.col("title"), F.lit("")))
    ct = text.clean_title(title)
    gt = text.tfidf_genres_text(F.col("genres"))
    out = m.select("movieId", title.alias("title"), "genres", ct.alias("clean_title"), gt.alias("genres_text"))
    out = out.withColumn("feature_text", text.feature_text(F.col("clean_title"), F.col("genres_text")))
    return out.filter(F.length("feature_text") > 0)


def term_counts(docs: DataFrame, doc: str = "movieId", text_col: str = "feature_text") -> DataFrame:
    """Raw counts ``(doc, term, tf)`` of unigrams and bigrams over whole texts.

    Tokenising is a JVM regex; stop words go through Spark ML's
    ``StopWordsRemover`` (a hash-set lookup) and bigrams through ``NGram``,
    both JVM-side transformers on array columns -- no Python per row.
    """
    from pyspark.ml.feature import NGram, StopWordsRemover

    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN), 0)
    texts = docs.select(F.col(doc).alias("doc"), text_col)
    spark = docs.sparkSession
    chars = texts.agg(F.sum(F.length(text_col))).first()[0] or 0
    tasks = [max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // CHARS_PER_TASK))] \
        if chars > CHARS_PER_TASK * spark.sparkContext.defaultParallelism else []  # else AQE sizes the tasks
    placed = texts.repartition(*tasks, "doc")  # texts are shuffled once, not their terms
    d = placed.select("doc", toks.alias("raw"))
    d = StopWordsRemover(inputCol="raw", outputCol="toks", stopWords=list(stopwords.english()),
                         caseSensitive=True).transform(d)
    d = NGram(n=2, inputCol="toks", outputCol="bigrams").transform(d)
    terms = d.select("doc", F.explode(F.concat("toks", "bigrams")).alias("term"))
    return terms.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf(docs: DataFrame, doc: str = "movieId", text_col: str = "feature_text", min_df: int = 2,
          max_features: int | None = 30000) -> tuple[DataFrame, DataFrame]:
    """``(weights(doc, term, weight), vocabulary(term, df, total, idf))``.

    The vocabulary is cut to ``max_features`` terms with a distributed
    top-N (``orderBy().limit()`` -> per-partition top-N, then a merge), so
    the kept vocabulary is bounded by ``max_features`` before it is joined.
    Over ``CHARS_PER_SLICE`` the vocabulary is written, and the weights slice
    by slice of documents: each text's terms pass two shuffles, which together
    are many times the texts.
    """
    slices = -(-(docs.agg(F.sum(F.length(text_col))).first()[0] or 0) // CHARS_PER_SLICE)
    tf = term_counts(docs, doc, text_col)
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")) \
        .filter(F.col("df") >= min_df)
    if max_features is not None:
        stats = stats.orderBy(F.col("total").desc(), F.col("term").asc()).limit(max_features)
    vocab = stats.select("term", "df", "total",
                         (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))

    def weights(counts: DataFrame) -> DataFrame:
        w = counts.join(vocab.select("term", "idf"), "term").select("doc", "term", (F.col("tf") * F.col("idf")).alias("raw"))
        norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc")))
        return w.filter(F.col("doc").isNotNull()).select(F.col("doc").alias(doc), "term", (F.col("raw") / norm).alias("weight"))

    if slices <= 1:
        return weights(tf), vocab
    vocab = stage(vocab)
    part_of = F.pmod(F.xxhash64(doc), F.lit(slices))
    return staged_parts(slices, lambda part: weights(term_counts(docs.filter(part_of == part), doc, text_col))), vocab


def similar_by_tfidf(weights: DataFrame, k: int = 10, doc: str = "movieId") -> DataFrame:
    """R15 for every item: top-``k`` cosine neighbours (self excluded) -> content_score."""
    return top_similar(weights, "term", doc, "weight", k).select(
        F.col("i").alias("query_movieId"), F.col("j").alias("movieId"), F.col("sim").alias("content_score"), "rank")
