from conftest import ratings_df

from sparkrec import session
from sparkrec.operators import cf, similarity


def unseen_case(spark):
    """Movies 11-13 are rated by all, 14 by all but the first three users; user 70 likes nothing."""
    rows = [(u, m, 3.5 + (u + m) % 3 / 2) for u in range(1, 21) for m in (11, 12, 13)]
    rows += [(u, 14, 4.5) for u in range(4, 21)]
    return ratings_df(spark, [*rows, (70, 11, 1.5), (70, 13, 3.0)], with_ts=False)


def test_cf_recommends_unseen(spark):
    r = unseen_case(spark)
    sim = similarity.item_similarity(r, 100)
    recs = cf.recommend(r, sim, r.select("userId").filter("userId = 1"), k=10).collect()
    assert [x.movieId for x in recs] == [14]


def test_status_rows(spark):
    r = unseen_case(spark)
    sim = similarity.item_similarity(r, 100)
    users = spark.createDataFrame([(1,), (5,), (70,), (8888,)], "userId long")
    got = {x.userId: x.status for x in cf.recommend_status(r, sim, users).collect()}
    assert got == {1: "ok", 5: "no_candidates", 70: "no_liked", 8888: "unknown_user"}


def test_true_top_k_not_first_k_by_id(spark):
    # More candidates than k, best ones at the highest ids
    sim = spark.createDataFrame([(1, j, j / 100.0, 100 - j) for j in range(2, 12)],
                                "movieId long, neighborId long, sim double, rank int")
    hist = ratings_df(spark, [(7, 1, 5.0)], with_ts=False)
    recs = cf.recommend(hist, sim, k=3).orderBy("rank").collect()
    assert [x.movieId for x in recs] == [11, 10, 9]
    assert [x.rank for x in recs] == [1, 2, 3]


def test_weighted_and_fallback(spark):
    sim = spark.createDataFrame([(1, 3, 0.5, 1), (2, 3, 0.25, 1), (2, 4, 0.2, 2)],
                                "movieId long, neighborId long, sim double, rank int")
    # user 7 likes nothing (all < 4) -> 5 best-rated are used (fallback)
    hist = ratings_df(spark, [(7, 1, 3.0), (7, 2, 2.0)], with_ts=False)
    got = {x.movieId: x.score for x in cf.candidate_scores(hist, sim, weighted=True, fallback=True).collect()}
    assert abs(got[3] - (0.5 * 3 / 5 + 0.25 * 2 / 5)) < 1e-12
    assert abs(got[4] - 0.2 * 2 / 5) < 1e-12
    assert cf.candidate_scores(hist, sim).count() == 0          # strict liked set: nothing
    one = {x.movieId for x in cf.candidate_scores(hist, sim, neighbors=1, weighted=True, fallback=True).collect()}
    assert one == {3}


def test_scores_lists_and_counts_need_one_shuffle_by_user(spark):
    hist = spark.range(400).selectExpr("id % 20 userId", "id movieId", "5.0D rating")
    sim = spark.range(400).selectExpr("id movieId", "(id + 7) % 400 neighborId", "0.5D sim", "1 rank")
    plan = cf.recommend(hist, sim)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(userId" in plan
    assert not any("hashpartitioning(userId" in line and "movieId" in line.split("hashpartitioning(userId")[1].split(")")[0]
                   for line in plan.splitlines())


def test_users_that_fill_tasks_alone_are_dealt_by_movie(spark, monkeypatch):
    hist = spark.range(400).selectExpr("CASE WHEN id < 300 THEN 0 ELSE id % 20 END userId", "id movieId", "5.0D rating")
    sim = spark.range(400).selectExpr("id movieId", "(id + 7) % 450 neighborId", "(1 + id % 5) / 10D sim", "1 rank")
    want = {tuple(r) for r in cf.recommend(hist, sim).collect()}
    monkeypatch.setattr(cf, "ROWS_PER_TASK", 500)
    assert {tuple(r) for r in cf.recommend(hist, sim).collect()} == want
    rows, keys = cf._by_user(hist.selectExpr("userId", "movieId", "1D c"), hist, 100)
    assert keys == ["userId", "_salt"] and rows.filter("userId = 0").select("_salt").distinct().count() > 1


def test_the_similarity_is_not_shuffled_for_few_users(spark):
    hist = ratings_df(spark, [(u, (u * 7 + m) % 500, 5.0) for u in range(400) for m in range(10)], with_ts=False)
    rows = [(m, (m + d) % 500, 1.0 / d, d) for m in range(500) for d in range(1, 11)]
    sim = spark.createDataFrame(rows, "movieId long, neighborId long, sim double, rank int")
    users = spark.createDataFrame([(3,)], "userId long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        few = cf.candidate_scores(hist, sim, users)
        plan = few._jdf.queryExecution().executedPlan().toString()
        got = {(x.userId, x.movieId): round(x.score, 8) for x in few.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    whole = cf.candidate_scores(hist, sim).filter("userId = 3").collect()
    assert got == {(x.userId, x.movieId): round(x.score, 8) for x in whole} and got


def test_slices_of_users_give_the_same_lists_and_counts(spark, monkeypatch):
    rows = [(u, (u * 7 + m * 3) % 60, 1.0 + (u + m) % 5) for u in range(40) for m in range(12)] + [(77, 1, 2.0), (None, 3, 5.0)]
    hist = ratings_df(spark, rows, with_ts=False)
    sim = spark.createDataFrame([(m, (m + d) % 60, 1.0 / d, d) for m in range(60) for d in range(1, 9)],
                                "movieId long, neighborId long, sim double, rank int")
    users = hist.select("userId").distinct()

    def results():
        recs = cf.recommend(hist, sim, k=5, weighted=True, fallback=True).collect()
        return ({(r.userId, r.movieId, round(r.score, 9), r.rank) for r in recs},
                {tuple(r) for r in cf.recommend_status(hist, sim, users).collect()})

    whole = results()
    written = []
    monkeypatch.setattr(cf, "ROWS_PER_SLICE", 5_000)
    monkeypatch.setattr(cf, "staged_parts", lambda n, make: written.append(n) or session.staged_parts(n, make))
    assert results() == whole and len(whole[0]) > 150
    assert len(written) == 2 and min(written) > 1
