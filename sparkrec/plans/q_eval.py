"""Queries for the evaluation harness.

The evaluation protocol samples 100 users (E13) by a portable md5 order:
sampling is the feature being reproduced, and every model, split and
similarity behind it is still built from the whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkrec.operators import cf, evaluate, metrics
from sparkrec.plans import common
from sparkrec.plans import oracle as O
from sparkrec.plans.common import core_ratings, r6
from sparkrec.plans.q_blend import PROFILE_FOR, hybrid_sql
from sparkrec.plans.q_content import CONTENT_BASE, movie_tfidf
from sparkrec.plans.registry import query
from sparkrec.session import cut_lineage

ALPHAS = (0.5, 0.6, 0.7, 0.8, 0.9)
ALPHA_SQL = ", ".join(f"({a})" for a in ALPHAS)

EU_SQL = """,
elig AS (SELECT userId FROM train INTERSECT SELECT userId FROM test WHERE rating >= 4),
eu AS (SELECT userId, md5(concat('42:', CAST(userId AS VARCHAR))) AS draw FROM elig ORDER BY draw LIMIT 100),
train_eu AS (SELECT * FROM train WHERE userId IN (SELECT userId FROM eu))"""

SUMMARY_COLS = ("model, top_k, positive_threshold, evaluated_users, precision_at_10, recall_at_10, "
                "hit_rate_at_10, average_matches, average_truth_items")


def per_user_sql(recs: str, catalog: str, model: str, name: str) -> str:
    return f""",
{name}_t AS (SELECT userId, movieId FROM test WHERE rating >= 4 AND userId IN (SELECT userId FROM eu)
             AND movieId IN (SELECT movieId FROM {catalog})),
{name} AS (SELECT '{model}' AS model, nt.userId, nt.num_truth, coalesce(nr.c, 0) AS num_recommended,
             coalesce(nm.c, 0) AS num_matched,
             CAST(coalesce(nm.c, 0) AS DOUBLE) / 10 AS precision_at_10,
             CAST(coalesce(nm.c, 0) AS DOUBLE) / nt.num_truth AS recall_at_10,
             CASE WHEN coalesce(nm.c, 0) > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS hit_rate_at_10
           FROM (SELECT userId, count(*) AS num_truth FROM {name}_t GROUP BY 1) nt
           LEFT JOIN (SELECT userId, count(*) AS c FROM {recs} WHERE rank <= 10 GROUP BY 1) nr USING (userId)
           LEFT JOIN (SELECT r.userId, count(*) AS c FROM {recs} r JOIN {name}_t t
                      ON r.userId = t.userId AND r.movieId = t.movieId WHERE r.rank <= 10 GROUP BY 1) nm
             USING (userId))"""


def summary_sql(pu: str, model: str, name: str) -> str:
    z = lambda c: f"coalesce(avg({c}), CAST(0 AS DOUBLE))"
    return f""",
{name} AS (SELECT '{model}' AS model, CAST(10 AS INTEGER) AS top_k, CAST(4 AS DOUBLE) AS positive_threshold,
             count(*) AS evaluated_users, {z('precision_at_10')} AS precision_at_10,
             {z('recall_at_10')} AS recall_at_10, {z('hit_rate_at_10')} AS hit_rate_at_10,
             {z('num_matched')} AS average_matches, {z('num_truth')} AS average_truth_items FROM {pu})"""


def round_summary(src: str, extra: str = "") -> str:
    return f"""SELECT {extra}model, top_k, positive_threshold, evaluated_users,
  round(precision_at_10, 6) AS precision_at_10, round(recall_at_10, 6) AS recall_at_10,
  round(hit_rate_at_10, 6) AS hit_rate_at_10, round(average_matches, 6) AS average_matches,
  round(average_truth_items, 6) AS average_truth_items FROM {src}"""


def round_per_user(src: str) -> str:
    return f"""SELECT model, userId, num_truth, num_recommended, num_matched, round(precision_at_10, 6) AS precision_at_10,
  round(recall_at_10, 6) AS recall_at_10, round(hit_rate_at_10, 6) AS hit_rate_at_10 FROM {src}"""


POP_SQL = """,
pop AS (SELECT movieId, count(*) AS rating_count, avg(rating) AS average_rating,
               count(*) FILTER (WHERE rating >= 4.0) AS positive_count FROM train GROUP BY movieId),
pr AS (SELECT *, row_number() OVER (ORDER BY positive_count DESC, average_rating DESC, rating_count DESC,
                                   movieId) AS pop_rank FROM pop),
pseen AS (SELECT userId, count(*) AS s FROM train_eu GROUP BY 1),
pcand AS (SELECT pseen.userId, pr.movieId, pr.pop_rank FROM pseen JOIN pr ON pr.pop_rank <= 10 + pseen.s
          WHERE NOT EXISTS (SELECT 1 FROM train_eu r WHERE r.userId = pseen.userId AND r.movieId = pr.movieId)),
prec AS (SELECT * FROM (SELECT userId, movieId, row_number() OVER (PARTITION BY userId ORDER BY pop_rank) AS rank
         FROM pcand) t WHERE rank <= 10),
pcat AS (SELECT DISTINCT movieId FROM train)""" + per_user_sql("prec", "pcat", "popular", "ppu") + \
    summary_sql("ppu", "popular", "psum")

CF30_SQL = "," + O.sim_sql("train", "sim", 100) + "," + O.liked_sql("train_eu", "lk30", True) + "," + \
    O.cf_scores_sql("train_eu", "lk30", "sim", "c30", 30, True) + """,
c30r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY round(score, 8) DESC, movieId)
         AS rank FROM c30) t WHERE rank <= 10),
ccat AS (SELECT DISTINCT movieId FROM train)""" + per_user_sql("c30r", "ccat", "knn_cf", "cpu") + \
    summary_sql("cpu", "knn_cf", "csum")

CONTENT_EVAL_SQL = PROFILE_FOR("train_eu") + """,
ctr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY round(score, 8) DESC, movieId)
        AS rank FROM cun) t WHERE rank <= 10),
tcat AS (SELECT DISTINCT movieId FROM weights)""" + per_user_sql("ctr", "tcat", "knn_content", "tpu") + \
    summary_sql("tpu", "knn_content", "tsum")


def _hybrid_eval_sql() -> str:
    # hybrid_sql defines its own profile CTEs; the content model above reuses them
    return hybrid_sql("train_eu", ALPHA_SQL) + """,
hcat AS (SELECT movieId FROM train UNION SELECT movieId FROM weights),
ht AS (SELECT userId, movieId FROM test WHERE rating >= 4 AND userId IN (SELECT userId FROM eu)
       AND movieId IN (SELECT movieId FROM hcat)),
hpu AS (SELECT 'hybrid' AS model, a.alpha, nt.userId, nt.num_truth, coalesce(nr.c, 0) AS num_recommended,
          coalesce(nm.c, 0) AS num_matched, CAST(coalesce(nm.c, 0) AS DOUBLE) / 10 AS precision_at_10,
          CAST(coalesce(nm.c, 0) AS DOUBLE) / nt.num_truth AS recall_at_10,
          CASE WHEN coalesce(nm.c, 0) > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS hit_rate_at_10
        FROM (SELECT userId, count(*) AS num_truth FROM ht GROUP BY 1) nt CROSS JOIN alphas a
        LEFT JOIN (SELECT alpha, userId, count(*) AS c FROM hrk GROUP BY 1, 2) nr
          ON nr.alpha = a.alpha AND nr.userId = nt.userId
        LEFT JOIN (SELECT h.alpha, h.userId, count(*) AS c FROM hrk h JOIN ht t
                   ON h.userId = t.userId AND h.movieId = t.movieId GROUP BY 1, 2) nm
          ON nm.alpha = a.alpha AND nm.userId = nt.userId),
hsum AS (SELECT alpha, 'hybrid' AS model, CAST(10 AS INTEGER) AS top_k, CAST(4 AS DOUBLE) AS positive_threshold,
           count(*) AS evaluated_users, avg(precision_at_10) AS precision_at_10, avg(recall_at_10) AS recall_at_10,
           avg(hit_rate_at_10) AS hit_rate_at_10, avg(num_matched) AS average_matches,
           avg(num_truth) AS average_truth_items FROM hpu GROUP BY alpha),
hbest AS (SELECT * FROM hsum ORDER BY round(precision_at_10, 8) DESC, round(recall_at_10, 8) DESC,
            round(hit_rate_at_10, 8) DESC, alpha LIMIT 1)"""


EVAL_BASE = [O.core_sql(), O.time_split_sql("core")]
FULL_BASE = CONTENT_BASE


def inputs(spark, sf):
    """The split and the sampled users (bounded rows, written once, as every model is scored for them)."""
    train, test = common.time_split(spark, sf)
    users = common.built(spark, ("eval_users",), sf, common.RATING_TABLES,
                         lambda: cut_lineage(evaluate.select_users(train, test, 100, 42, 4.0)))
    return train, test, users


def per_user_rows(spark, sf, name, make):
    """A model's per-user rows, scored and written once; its summaries are aggregates of them."""
    return common.built(spark, ("eval", name), sf, common.RATING_TABLES + common.MOVIE_TABLES, lambda: cut_lineage(make()[0]))


@query("eval_users", O.with_(*EVAL_BASE) + EU_SQL + "\nSELECT userId, draw FROM eu")
def q_eval_users(spark, sf):
    return inputs(spark, sf)[2]


def _pu(df):
    return df.select("model", "userId", "num_truth", "num_recommended", "num_matched",
                     r6("precision_at_10").alias("precision_at_10"), r6("recall_at_10").alias("recall_at_10"),
                     r6("hit_rate_at_10").alias("hit_rate_at_10"))


def _sum(df, extra=()):
    return df.select(*extra, "model", "top_k", "positive_threshold", "evaluated_users",
                     *[r6(c).alias(c) for c in ("precision_at_10", "recall_at_10", "hit_rate_at_10",
                                                "average_matches", "average_truth_items")])


def popular_eval(spark, sf):
    train, test, users = inputs(spark, sf)
    rows = per_user_rows(spark, sf, "popular", lambda: evaluate.evaluate_popular(train, test, users, 10, 4.0))
    return rows, metrics.summarize(rows, "popular", 10, 4.0)


def cf_eval(spark, sf):
    train, test, users = inputs(spark, sf)
    sim = common.train_similarity(spark, sf)
    rows = per_user_rows(spark, sf, "cf", lambda: evaluate.evaluate_cf(train, test, users, sim, 10, 30, 4.0))
    return rows, metrics.summarize(rows, "knn_cf", 10, 4.0)


def content_eval(spark, sf):
    train, test, users = inputs(spark, sf)
    w, _ = movie_tfidf(spark, sf)
    rows = per_user_rows(spark, sf, "content", lambda: evaluate.evaluate_content(train, test, users, w, 10, 4.0))
    return rows, metrics.summarize(rows, "knn_content", 10, 4.0)


def sweep(spark, sf):
    train, test, users = inputs(spark, sf)
    sim = common.train_similarity(spark, sf)
    w, _ = movie_tfidf(spark, sf)
    rows = per_user_rows(spark, sf, "hybrid", lambda: evaluate.alpha_sweep(train, test, users, sim, w, ALPHAS, 10, 50, 4.0, 500))
    return rows, evaluate.alpha_summary(rows, 10, 4.0)


@query("eval_popular_users", O.with_(*EVAL_BASE) + EU_SQL + POP_SQL + "\n" + round_per_user("ppu"))
def q_eval_popular_users(spark, sf):
    return _pu(popular_eval(spark, sf)[0])


@query("eval_popular_summary", O.with_(*EVAL_BASE) + EU_SQL + POP_SQL + "\n" + round_summary("psum"))
def q_eval_popular_summary(spark, sf):
    return _sum(popular_eval(spark, sf)[1])


@query("eval_cf_users", O.with_(*EVAL_BASE) + EU_SQL + CF30_SQL + "\n" + round_per_user("cpu"))
def q_eval_cf_users(spark, sf):
    return _pu(cf_eval(spark, sf)[0])


@query("eval_cf_summary", O.with_(*EVAL_BASE) + EU_SQL + CF30_SQL + "\n" + round_summary("csum"))
def q_eval_cf_summary(spark, sf):
    return _sum(cf_eval(spark, sf)[1])


@query("eval_content_summary", O.with_(*FULL_BASE) + EU_SQL + CONTENT_EVAL_SQL + "\n" + round_summary("tsum"))
def q_eval_content_summary(spark, sf):
    return _sum(content_eval(spark, sf)[1])


@query("eval_blend_sweep", O.with_(*FULL_BASE) + EU_SQL + _hybrid_eval_sql() + "\n" +
       round_summary("hsum", "alpha, "))
def q_eval_blend_sweep(spark, sf):
    return _sum(sweep(spark, sf)[1], ("alpha",))


@query("best_alpha", O.with_(*FULL_BASE) + EU_SQL + _hybrid_eval_sql() + "\n" + round_summary("hbest", "alpha, "))
def q_best_alpha(spark, sf):
    return _sum(evaluate.best_alpha(sweep(spark, sf)[1]), ("alpha",))


def comparison(spark, sf):
    best = evaluate.best_alpha(sweep(spark, sf)[1])
    return evaluate.compare_models([popular_eval(spark, sf)[1], cf_eval(spark, sf)[1], content_eval(spark, sf)[1], best])


COMPARISON_SQL = (O.with_(*FULL_BASE) + EU_SQL + _hybrid_eval_sql() + POP_SQL
                  + CF30_SQL.replace("," + O.sim_sql("train", "sim", 100), "") + """,
ctr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY round(score, 8) DESC, movieId)
        AS rank FROM cun) t WHERE rank <= 10),
tcat AS (SELECT DISTINCT movieId FROM weights)""" + per_user_sql("ctr", "tcat", "knn_content", "tpu")
                  + summary_sql("tpu", "knn_content", "tsum") + """,
cmp AS (SELECT CAST(NULL AS DOUBLE) AS alpha, * FROM psum UNION ALL SELECT NULL, * FROM csum
        UNION ALL SELECT NULL, * FROM tsum UNION ALL SELECT alpha, """ + SUMMARY_COLS + " FROM hbest)")


@query("model_comparison", COMPARISON_SQL + "\n" + round_summary("cmp", "alpha, "))
def q_model_comparison(spark, sf):
    return _sum(comparison(spark, sf), ("alpha",))


@query("metrics_long", COMPARISON_SQL + """
SELECT model, alpha, metric, round(value, 6) AS value FROM (
  UNPIVOT (SELECT model, alpha, precision_at_10, recall_at_10, hit_rate_at_10, average_matches,
                  average_truth_items FROM cmp)
  ON precision_at_10, recall_at_10, hit_rate_at_10, average_matches, average_truth_items
  INTO NAME metric VALUE value) u""")
def q_metrics_long(spark, sf):
    m = evaluate.metrics_long(comparison(spark, sf), 10, id_cols=("model", "alpha"))
    return m.select("model", "alpha", "metric", r6("value").alias("value"))


@query("recall_hist", O.with_(*EVAL_BASE) + EU_SQL + CF30_SQL + """
SELECT CAST(least(floor(recall_at_10 * 20), 19) AS INTEGER) AS bin, count(*) AS n_users FROM cpu GROUP BY 1""")
def q_recall_hist(spark, sf):
    return evaluate.recall_histogram(cf_eval(spark, sf)[0], 10, 20)


@query("recall_summary", O.with_(*EVAL_BASE) + EU_SQL + CF30_SQL + """
SELECT round(avg(hit_rate_at_10), 6) AS hit_share, round(avg(recall_at_10), 6) AS mean_recall,
       round(max(recall_at_10), 6) AS max_recall FROM cpu""")
def q_recall_summary(spark, sf):
    s = evaluate.recall_summary(cf_eval(spark, sf)[0])
    return s.select(*[r6(c).alias(c) for c in s.columns])


@query("leakage_check", O.with_(*EVAL_BASE, O.sim_sql("train", "sim", 100), O.liked_sql("train", "liked", True),
                                O.cf_scores_sql("train", "liked", "sim", "sc", 30, True)) + """,
rec AS (""" + O.top_k_sql("sc", 10) + """)
SELECT count(*) AS n_leaks FROM rec JOIN train USING (userId, movieId)""")
def q_leakage_check(spark, sf):
    train, _ = common.time_split(spark, sf)
    sim = common.train_similarity(spark, sf)
    recs = cf.recommend(train, sim, k=10, neighbors=30, weighted=True, fallback=True)
    return evaluate.leakage(recs, train).agg(F.count(F.lit(1)).alias("n_leaks"))


LLO_SQL = O.with_(O.core_sql()) + """,
llo AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, movieId DESC) AS rn FROM core),
ltrain AS (SELECT userId, movieId, rating, ts FROM llo WHERE rn > 1),
ltest AS (SELECT userId, movieId, rating, ts FROM llo WHERE rn = 1),""" + O.sim_sql("ltrain", "lsim", 100) + """,
lelig AS (SELECT DISTINCT userId FROM ltest WHERE movieId IN (SELECT movieId FROM ltrain)),
leu AS (SELECT userId, md5(concat('42:', CAST(userId AS VARCHAR))) AS draw FROM lelig ORDER BY draw LIMIT {n}),
leur AS (SELECT userId, row_number() OVER (ORDER BY draw) AS dr FROM leu),
lliked AS (SELECT * FROM ltrain WHERE rating >= 4 AND userId IN (SELECT userId FROM leu)),""" + \
    O.cf_scores_sql("ltrain", "lliked", "lsim", "lsc", None, False) + """,
lst AS (SELECT leu.userId, CASE
          WHEN NOT EXISTS (SELECT 1 FROM ltrain t WHERE t.userId = leu.userId) THEN 'unknown_user'
          WHEN NOT EXISTS (SELECT 1 FROM lliked t WHERE t.userId = leu.userId) THEN 'no_liked'
          WHEN NOT EXISTS (SELECT 1 FROM lsc t WHERE t.userId = leu.userId) THEN 'no_candidates'
          ELSE 'ok' END AS status FROM leu),
lrec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY round(score, 8) DESC, movieId)
         AS rank FROM lsc) t WHERE rank <= 10),
lrow AS (SELECT s.userId, r.dr, s.status,
           CASE WHEN s.status <> 'ok' THEN NULL WHEN x.rank IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS hit,
           CASE WHEN s.status <> 'ok' THEN NULL WHEN x.rank IS NOT NULL THEN 1.0 / log2(x.rank + 1)
                ELSE CAST(0 AS DOUBLE) END AS ndcg
         FROM lst s JOIN leur r USING (userId) JOIN ltest t USING (userId)
         LEFT JOIN lrec x ON x.userId = t.userId AND x.movieId = t.movieId)"""


def hit_summary_sql(src: str, extra: str = "", group: str = "") -> str:
    return f"""SELECT {extra}count(*) FILTER (WHERE status = 'ok') AS users_evaluated,
  round(coalesce(avg(hit), 0), 6) AS HR_at_10, round(coalesce(avg(ndcg), 0), 6) AS NDCG_at_10,
  round(count(*) FILTER (WHERE hit > 0) / count(*), 6) AS HR_at_10_all,
  round(coalesce(sum(ndcg), 0) / count(*), 6) AS NDCG_at_10_all,
  count(*) FILTER (WHERE status = 'ok' AND hit IS NULL) AS n_missing_truth, count(*) FILTER (WHERE status <> 'ok') AS n_cold_start FROM {src} {group}"""


def _hit_round(df, extra=()):
    return df.select(*extra, "users_evaluated", *[r6(c).alias(c) for c in
                                                  ("HR_at_10", "NDCG_at_10", "HR_at_10_all", "NDCG_at_10_all")],
                     "n_missing_truth", "n_cold_start")


@query("eval_leave_last_out", LLO_SQL.replace("{n}", "200") + "\n" + hit_summary_sql("lrow"))
def q_eval_leave_last_out(spark, sf):
    return _hit_round(evaluate.leave_last_out_eval(core_ratings(spark, sf, 20, 20), 200))


@query("eval_leave_last_out_all", LLO_SQL.replace("LIMIT {n}", "") + "\n" + hit_summary_sql("lrow"))
def q_eval_leave_last_out_all(spark, sf):
    """The whole population (sample 0)."""
    return _hit_round(evaluate.leave_last_out_eval(core_ratings(spark, sf, 20, 20), 0))


@query("eval_sample_sweep", LLO_SQL.replace("{n}", "200") + """,
sizes AS (SELECT * FROM (VALUES (50), (100), (200)) v(sample_size)),
lsw AS (SELECT sizes.sample_size, lrow.* FROM sizes JOIN lrow ON lrow.dr <= sizes.sample_size)
""" + hit_summary_sql("lsw", "CAST(sample_size AS INTEGER) AS sample_size, ", "GROUP BY sample_size"))
def q_eval_sample_sweep(spark, sf):
    return _hit_round(evaluate.sample_sweep(core_ratings(spark, sf, 20, 20)), ("sample_size",))
