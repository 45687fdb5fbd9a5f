import math

import pytest

from sparkrec.operators import content, metrics


def recs_df(spark, rows):
    return spark.createDataFrame(rows, "userId long, movieId long, rank int")


def truth_df(spark, rows):
    return spark.createDataFrame(rows, "userId long, movieId long")


def test_precision_recall_hit(spark):
    recs = recs_df(spark, [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 20, 1)])
    truth = truth_df(spark, [(1, 11, ), (1, 99), (2, 98), (3, 5)])
    got = {r.userId: r for r in metrics.per_user_metrics(recs, truth, k=2, model="m").collect()}
    assert got[1].num_matched == 1 and got[1].num_recommended == 2
    assert got[1].precision_at_2 == 0.5 and got[1].recall_at_2 == 0.5 and got[1].hit_rate_at_2 == 1.0
    assert got[2].precision_at_2 == 0.0 and got[2].hit_rate_at_2 == 0.0
    assert got[3].num_recommended == 0 and got[3].recall_at_2 == 0.0     # empty recommendations
    s = metrics.summarize(metrics.per_user_metrics(recs, truth, 2, "m"), "m", 2).first()
    assert s.evaluated_users == 3 and abs(s.precision_at_2 - 0.5 / 3) < 1e-12
    with pytest.raises(ValueError):
        metrics.per_user_metrics(recs, truth, k=0)


def test_empty_summary_is_zero(spark):
    recs = recs_df(spark, [])
    truth = truth_df(spark, [])
    s = metrics.summarize(metrics.per_user_metrics(recs, truth, 10, "m"), "m").first()
    assert s.evaluated_users == 0 and s.precision_at_10 == 0.0 and s.average_truth_items == 0.0


def test_hit_and_ndcg(spark):
    recs = recs_df(spark, [(1, 5, 1), (1, 6, 2), (1, 7, 3), (2, 8, 1)])
    truth = truth_df(spark, [(1, 7), (2, 9)])
    got = {r.userId: r for r in metrics.hit_and_ndcg(recs, truth, 10).collect()}
    assert got[1].hit == 1.0 and abs(got[1].ndcg - 1 / math.log2(4)) < 1e-12
    assert got[2].hit == 0.0 and got[2].ndcg == 0.0


def test_genre_overlap(spark):
    mc = spark.createDataFrame([(1, ["Drama", "War"]), (2, ["Drama"]), (3, ["Comedy"]), (4, [])],
                               "movieId long, genres_list array<string>")
    recs = spark.createDataFrame([(1, 2, 1), (1, 3, 2), (4, 2, 1)], "query_movieId long, movieId long, rank int")
    got = {r.query_movieId: r.genre_overlap for r in content.genre_overlap(recs, mc, k=10).collect()}
    assert got == {1: 0.5, 4: 0.0}
