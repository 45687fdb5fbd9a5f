"""Bucketed tables: the same rows, and plans without an exchange of the ratings."""

import uuid

import pytest
from conftest import ratings_df
from pyspark.sql import functions as F

from sparkrec.operators import cf, clean, similarity
from sparkrec.session import ensure_checkpoint_dir
from sparkrec.sources import bucketed


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def path(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-bucketed/{uuid.uuid4().hex}"


def test_recommendations_from_buckets_need_no_exchange_on_users(spark):
    ratings = ratings_df(spark, [(u, m, 1.0 + (u * m) % 9 / 2, u + m) for u in range(80) for m in range(30) if (u * 7 + m) % 3])
    p = path(spark)
    assert bucketed.save_bucketed(ratings, p, "userId", 4) == 4
    table = bucketed.open_bucketed(spark, p)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, ratings.collect()))
    sim_path = path(spark)
    similarity.item_similarity(ratings, 10).write.parquet(sim_path)
    sim = spark.read.parquet(sim_path)
    # a full key of each join is asked for by default; a part of it, the user, places the rows as well
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        from_buckets, plain = (cf.recommend(t, sim, k=5) for t in (table, ratings))
        assert "hashpartitioning(userId" not in plan_of(from_buckets) and "hashpartitioning(userId" in plan_of(plain)
        assert sorted(map(tuple, from_buckets.select("userId", "movieId", "rank").collect())) == sorted(
            map(tuple, plain.select("userId", "movieId", "rank").collect()))
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    latest = clean.dedup_latest(table)
    assert "Exchange" not in plan_of(latest) and latest.count() == ratings.count()
    assert "Exchange" not in plan_of(table.groupBy("userId").agg(F.avg("rating")))


def test_hot_keys_and_missing_tables_are_refused(spark, monkeypatch):
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 50)
    hot = ratings_df(spark, [(1, m, 3.0) for m in range(100)] + [(u, 1, 3.0) for u in range(2, 200)])
    with pytest.raises(ValueError, match="userId 1 holds 100"):
        bucketed.save_bucketed(hot, path(spark), "userId")
    assert bucketed.save_bucketed(hot.filter("userId > 1"), (p := path(spark)), "userId") == 4
    assert bucketed.open_bucketed(spark, p).count() == 198
    with pytest.raises(FileNotFoundError):
        bucketed.open_bucketed(spark, path(spark))
    assert bucketed.save_bucketed(hot.limit(0), (p := path(spark)), "userId") == 1 and bucketed.open_bucketed(spark, p).count() == 0
