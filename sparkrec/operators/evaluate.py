"""Offline evaluation harness.

A "recommender" here is any function ``DataFrame(userId) -> DataFrame(userId,
movieId, rank)``: the whole sample is scored in one distributed job, and the
metrics are joins and aggregates (no per-user Python loop).
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.operators import blend, cf, metrics, profile, similarity, split, stats
from sparkrec.session import cut_lineage, stage


def draw_key(seed: int):
    """Portable, layout-independent sampling order: md5 of ``'{seed}:{userId}'``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("userId").cast("string")))


def select_users(train: DataFrame, test: DataFrame, n: int | None = 100, seed: int = 42,
                 threshold: float = 4.0) -> DataFrame:
    """Users with train history and a positive test row; the first ``n`` by draw key.

    Output ``(userId, draw)``.  The first ``n`` of the same order are nested,
    so smaller samples are prefixes of larger ones (E19).
    """
    eligible = train.select("userId").distinct().intersect(
        test.filter(F.col("rating") >= threshold).select("userId").distinct())
    out = eligible.select("userId", draw_key(seed).alias("draw"))
    if n is not None:
        out = out.orderBy("draw").limit(n)
    return out


def truth(test: DataFrame, users: DataFrame, catalog: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Positive test items of the sampled users that the model can recommend."""
    return (test.filter(F.col("rating") >= threshold).select("userId", "movieId")
            .join(users.select("userId"), "userId", "left_semi")
            .join(catalog.select("movieId").distinct(), "movieId", "left_semi"))


def evaluate_model(name: str, recs: DataFrame, test: DataFrame, users: DataFrame, catalog: DataFrame,
                   k: int = 10, threshold: float = 4.0) -> tuple[DataFrame, DataFrame]:
    """Per-user rows and the summary row."""
    t = truth(test, users, catalog, threshold)
    per_user = metrics.per_user_metrics(recs.join(users.select("userId"), "userId", "left_semi"), t, k, name)
    return per_user, metrics.summarize(per_user, name, k, threshold)


def popular_recs_for(train: DataFrame, users: DataFrame, k: int = 10, threshold: float = 4.0) -> DataFrame:
    ranked = stats.ranked_popularity(stats.popular_ranking(train, threshold))
    return stats.popular_recs(users, train, ranked, k)


def evaluate_popular(train, test, users, k=10, threshold=4.0):
    """The popularity baseline; its catalog is the set of ranked (train) movies."""
    recs = popular_recs_for(train, users, k, threshold)
    return evaluate_model("popular", recs, test, users, train.select("movieId"), k, threshold)


def evaluate_cf(train, test, users, sim, k=10, neighbors=30, threshold=4.0):
    """E14 with R9 (weighted, 5-best fallback); catalog = movies of the train matrix."""
    recs = cf.recommend(train, sim, users, k, threshold, neighbors=neighbors, weighted=True, fallback=True)
    return evaluate_model("knn_cf", recs, test, users, train.select("movieId"), k, threshold)


def evaluate_content(train, test, users, weights, k=10, threshold=4.0):
    """E14 with R17; catalog = movies with TF-IDF rows."""
    recs = profile.ranked_content(train, weights, k, threshold, users)
    return evaluate_model("knn_content", recs, test, users, weights.select("movieId"), k, threshold)


def alpha_sweep(train, test, users, sim, weights, alphas=(0.5, 0.6, 0.7, 0.8, 0.9), k=10,
                neighbors=50, threshold=4.0, content_limit=500) -> tuple[DataFrame, DataFrame]:
    """Candidate scores once, every alpha scored on them; per-user and summary rows."""
    cands = blend.hybrid_candidates(train, sim, weights, users, neighbors, threshold, content_limit)
    recs = blend.sweep_alphas(cands, alphas, k)
    catalog = train.select("movieId").union(weights.select("movieId")).distinct()
    t = truth(test, users, catalog, threshold)
    nt = t.groupBy("userId").agg(F.count(F.lit(1)).alias("num_truth"))
    al = F.explode(F.array(*[F.lit(float(a)) for a in alphas])).alias("alpha")
    base = nt.select("userId", "num_truth", al)
    top = recs.filter(F.col("rank") <= k).select("alpha", "userId", "movieId")
    nr = top.groupBy("alpha", "userId").agg(F.count(F.lit(1)).alias("num_recommended"))
    nm = top.join(t, ["userId", "movieId"], "left_semi").groupBy("alpha", "userId") \
        .agg(F.count(F.lit(1)).alias("num_matched"))
    j = base.join(nr, ["alpha", "userId"], "left").join(nm, ["alpha", "userId"], "left")
    m = F.coalesce("num_matched", F.lit(0)).cast("long")
    per_user = j.select(F.lit("hybrid").alias("model"), "alpha", "userId", "num_truth",
                        F.coalesce("num_recommended", F.lit(0)).cast("long").alias("num_recommended"),
                        m.alias("num_matched"), (m / F.lit(float(k))).alias(f"precision_at_{k}"),
                        (m / F.col("num_truth")).alias(f"recall_at_{k}"),
                        F.when(m > 0, 1.0).otherwise(0.0).alias(f"hit_rate_at_{k}"))
    return per_user, alpha_summary(per_user, k, threshold)


def alpha_summary(per_user: DataFrame, k: int = 10, threshold: float = 4.0) -> DataFrame:
    """One summary row per alpha of the sweep's per-user rows."""
    z = lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    return per_user.groupBy("alpha").agg(
        F.lit("hybrid").alias("model"), F.lit(k).alias("top_k"), F.lit(float(threshold)).alias("positive_threshold"),
        F.count(F.lit(1)).alias("evaluated_users"), z(f"precision_at_{k}").alias(f"precision_at_{k}"),
        z(f"recall_at_{k}").alias(f"recall_at_{k}"), z(f"hit_rate_at_{k}").alias(f"hit_rate_at_{k}"),
        z("num_matched").alias("average_matches"), z("num_truth").alias("average_truth_items"))


def best_alpha(summary: DataFrame, k: int = 10) -> DataFrame:
    """T4/T5 (D12): best by precision, recall, hit rate (desc), then alpha asc."""
    r = lambda c: F.round(F.col(c), 8).desc()  # noqa: E731 - means compared at 8 dp (float-order noise)
    return summary.orderBy(r(f"precision_at_{k}"), r(f"recall_at_{k}"), r(f"hit_rate_at_{k}"),
                           F.col("alpha").asc()).limit(1)


def compare_models(summaries: list[DataFrame]) -> DataFrame:
    """Stack summaries whose columns differ (hybrid has ``alpha``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), summaries)


def metrics_long(summary: DataFrame, k: int = 10, id_cols=("model",)) -> DataFrame:
    """Wide summary -> (model, metric, value)."""
    vals = [f"precision_at_{k}", f"recall_at_{k}", f"hit_rate_at_{k}", "average_matches", "average_truth_items"]
    s = summary.select(*id_cols, *[F.col(v).cast("double").alias(v) for v in vals])
    return s.unpivot(list(id_cols), vals, "metric", "value")


def recall_histogram(per_user: DataFrame, k: int = 10, bins: int = 20) -> DataFrame:
    """Users per recall bin ``least(floor(recall * bins), bins - 1)``."""
    b = F.least(F.floor(F.col(f"recall_at_{k}") * bins), F.lit(bins - 1)).cast("int")
    return per_user.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_users"))


def recall_summary(per_user: DataFrame, k: int = 10) -> DataFrame:
    """Hit share, mean and max recall."""
    return per_user.agg(F.avg(f"hit_rate_at_{k}").alias("hit_share"), F.avg(f"recall_at_{k}").alias("mean_recall"),
                        F.max(f"recall_at_{k}").alias("max_recall"))


def leakage(recs: DataFrame, history: DataFrame) -> DataFrame:
    """Recommended pairs the user has already seen (expected: none)."""
    return recs.select("userId", "movieId").join(history.select("userId", "movieId"),
                                                 ["userId", "movieId"], "left_semi")


def _leave_last_out_scores(ratings: DataFrame, sample: int | None, k: int, min_rating: float, seed: int,
                           top_k_sim: int):
    """E9-E11 core: per sampled user ``(userId, draw_rank, status, hit, ndcg)``.

    The similarity and each user's list with its number of candidates are
    written once; states and metrics are read from them.
    """
    from pyspark.sql import Window

    train, test = split.leave_last_out(ratings)  # written by the split
    sim = similarity.item_similarity(train, top_k_sim, write=True)
    eligible = test.join(train.select("movieId").distinct(), "movieId", "left_semi").select("userId").distinct()
    users = eligible.select("userId", draw_key(seed).alias("draw"))
    if sample:
        users = users.orderBy("draw").limit(sample)
        # the sample is bounded by ``sample`` rows, so one ordered window is fine here
        users = users.withColumn("draw_rank", F.row_number().over(Window.orderBy("draw")))
    else:
        users = users.withColumn("draw_rank", F.lit(None).cast("int"))
    users = cut_lineage(users)

    def lists(history: DataFrame) -> DataFrame:
        candidates = cf.candidate_scores(history, sim, users, min_rating).withColumn(
            "n_candidates", F.count(F.lit(1)).over(Window.partitionBy("userId")))
        return cf.top_k_per_user(candidates, k)

    listed = stage(cf.in_user_slices(train, users, min_rating, None, False, lists))
    status = cf.recommend_status(train, sim, users, min_rating, listed.select("userId", "n_candidates").distinct())
    ok = status.filter(F.col("status") == "ok").select("userId")  # these have candidates
    recs = listed.drop("n_candidates")
    t = test.join(ok, "userId", "left_semi").select("userId", "movieId")
    scores = metrics.hit_and_ndcg(recs, t, k)
    return (users.join(status.select("userId", "status"), "userId")
            .join(scores, "userId", "left").select("userId", "draw_rank", "status", "hit", "ndcg"))


def _hit_summary(rows: DataFrame, k: int = 10) -> DataFrame:
    """HR and NDCG (named by ``k``) over the users served and over all."""
    ev = F.col("status") == "ok"
    share = lambda x: F.coalesce(F.try_divide(x, F.count(F.lit(1))), F.lit(0.0))
    return rows.agg(
        F.count_if(ev).alias("users_evaluated"),
        F.coalesce(F.avg(F.when(ev, F.col("hit"))), F.lit(0.0)).alias(f"HR_at_{k}"),
        F.coalesce(F.avg(F.when(ev, F.col("ndcg"))), F.lit(0.0)).alias(f"NDCG_at_{k}"),
        share(F.count_if(ev & (F.col("hit") > 0))).alias(f"HR_at_{k}_all"),
        share(F.sum(F.when(ev, F.col("ndcg")))).alias(f"NDCG_at_{k}_all"),
        F.count_if(ev & F.col("hit").isNull()).alias("n_missing_truth"),
        F.count_if(~ev).alias("n_cold_start"))


def leave_last_out_eval(ratings: DataFrame, sample: int | None = 200, k: int = 10,
                        min_rating: float = 4.0, seed: int = 42, top_k_sim: int = 100) -> DataFrame:
    """Leave-last-out split, R4/R6 on the full train, HR/NDCG on a sample.

    Eligible users: their held-out movie is in the train catalog; ``sample``
    users are drawn by the md5 key (``None``/0 = everyone).  Users that R6
    cannot serve (unknown / no liked / no candidates) count as cold start and
    stay in the ``_all`` denominators (A11/A12).
    """
    return _hit_summary(_leave_last_out_scores(ratings, sample, k, min_rating, seed, top_k_sim), k)


def sample_sweep(ratings: DataFrame, sizes=(50, 100, 200), k: int = 10, min_rating: float = 4.0,
                 seed: int = 42) -> DataFrame:
    """The draw order is nested, so the largest sample is scored once and
    each smaller size is a prefix of it."""
    rows = _leave_last_out_scores(ratings, max(sizes), k, min_rating, seed, 100)
    parts = [_hit_summary(rows.filter(F.col("draw_rank") <= n), k).select(F.lit(n).alias("sample_size"), "*")
             for n in sizes]
    return reduce(lambda a, b: a.unionByName(b), parts)


def timed_sweep(ratings: DataFrame, sizes=(50, 100, 200), k: int = 10, min_rating: float = 4.0,
                seed: int = 42) -> DataFrame:
    """E19 with ``elapsed_s``: each size is evaluated by itself, from split to summary, and timed by the driver."""
    spark = ratings.sparkSession
    out = []
    for n in sizes:
        start = time.monotonic()
        row = leave_last_out_eval(ratings, n, k, min_rating, seed).first().asDict()
        out.append({"sample_size": n, **row, "elapsed_s": time.monotonic() - start})
    return spark.createDataFrame(out, ", ".join(
        f"{name} {'long' if isinstance(value, int) else 'double'}" for name, value in out[0].items()))
