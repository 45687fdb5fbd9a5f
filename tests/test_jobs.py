import os
import uuid

import pytest

from sparkrec.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_prepare_then_evaluate(spark):
    from sparkrec.jobs import evaluate, prepare
    from sparkrec.sources import fixtures, io

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-jobs/{uuid.uuid4().hex}"
    info = prepare.run(spark, fixtures.movies_raw(spark, SF), fixtures.ratings_raw(spark, SF), f"{base}/processed",
                       cf=(20, 20), content=(20, 5))
    assert info["ratings_cf_passes"] >= 1
    movies, cf, content = io.load_processed(spark, f"{base}/processed")
    assert cf.count() == 4790 and content.count() >= cf.count()
    assert dict(cf.dtypes) == {"userId": "int", "movieId": "int", "rating": "float", "timestamp": "bigint"}
    evaluate.run(movies, io.load_ratings(cf), f"{base}/eval", users_n=20, models=("popular", "cf"))
    cmp = spark.read.option("header", True).csv(f"{base}/eval/model_comparison")
    assert sorted(r.model for r in cmp.collect()) == ["knn_cf", "popular"]


def small(spark):
    """Ratings and movies of a few users, and a fresh output folder."""
    import numpy as np
    from conftest import movies_df, ratings_df

    rng = np.random.default_rng(6)
    ratings = ratings_df(spark, [(u, int(m), float(rng.integers(2, 11)) / 2, int(t)) for u in range(25)
                                 for t, m in enumerate(rng.choice(20, 9, replace=False))])
    genres = ["Drama", "Comedy|Drama", "Action", "Action|Comedy"]
    movies = movies_df(spark, [(m, f"Film {'abcdef'[m % 6]} {m % 4} ({1990 + m})", genres[m % 4]) for m in range(20)])
    return ratings, movies, f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-jobs/{uuid.uuid4().hex}"


def test_evaluation_job_resumes_and_gives_the_same_files(spark, monkeypatch):
    from sparkrec.jobs import evaluate

    ratings, movies, out = small(spark)
    options = {"users_n": 10, "k": 3, "alphas": (0.2, 0.8)}
    whole = evaluate.run(movies, ratings, f"{out}/a", **options)
    assert whole == ["train", "test", "users", "similarity", "weights", "popular_user_metrics", "cf_user_metrics",
                     "content_user_metrics", "hybrid_user_metrics", "alpha_summary", "comparison"]
    rows = spark.read.option("header", True).csv(f"{out}/a/model_comparison").collect()
    assert sorted(r["model"] for r in rows) == ["hybrid", "knn_cf", "knn_content", "popular"] and "recall_at_3" in rows[0].asDict()
    assert spark.read.json(f"{out}/a/hybrid_best_alpha").count() == 1
    assert spark.read.option("header", True).csv(f"{out}/a/hybrid_alpha_comparison").count() == 2

    def lost(*_args, **_kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(evaluate.evaluate, "evaluate_content", lost)
        with pytest.raises(RuntimeError):
            evaluate.run(movies, ratings, f"{out}/b", **options)
    rest = evaluate.run(movies, ratings, f"{out}/b", **options)
    assert rest == ["content_user_metrics", "hybrid_user_metrics", "alpha_summary", "comparison"]
    assert evaluate.run(movies, ratings, f"{out}/b", **options) == []
    for name in ("popular", "cf", "content", "hybrid"):
        a, b = (sorted(map(str, spark.read.parquet(f"{out}/{x}/{name}_user_metrics").collect())) for x in "ab")
        assert a == b and a
    assert "cf_user_metrics" in evaluate.run(movies, ratings.filter("userId > 0"), f"{out}/b", **options)  # other input


def test_training_jobs_commit_loadable_models(spark):
    from sparkrec.jobs import train_cf, train_content
    from sparkrec.sources import model_store

    ratings, movies, out = small(spark)
    assert train_cf.run(ratings, out, top_k=5) == ["train", "test", "similarity"]
    assert train_cf.run(ratings, out, top_k=5) == []
    train, test = (spark.read.parquet(f"{out}/rating_cf_{n}.parquet") for n in ("train", "test"))
    assert train.count() + test.count() == ratings.count()
    model = model_store.load_cf_model(spark, f"{out}/knn_cf", expected_n_ratings=train.count())
    meta = model_store.load_bundle(spark, f"{out}/knn_cf", "metadata")["metadata"].first()
    assert (meta["n_train"], meta["n_test"], meta["similarity_nnz"]) == (train.count(), test.count(), model["similarity"].count())
    assert train_content.run(movies, out, min_df=1, k=4) == ["features", "weights", "vocabulary", "similar_items"]
    bundle = model_store.load_bundle(spark, f"{out}/knn_content", "item_features", "vocabulary", "similar_items", "metadata")
    assert bundle["metadata"].first()["n_features"] == bundle["vocabulary"].count()
    assert bundle["similar_items"].groupBy("query_movieId").count().agg({"count": "max"}).first()[0] <= 4


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_command_lines(spark, tmp_path):
    from sparkrec.jobs import build_all, leave_last_out, prepare
    from sparkrec.sources import bucketed, io, model_store

    ratings, movies, _ = small(spark)
    csv = tmp_path / "csv"
    csv.mkdir()
    pandas_ratings, pandas_movies = ratings.toPandas(), movies.toPandas()
    pandas_ratings.to_csv(csv / "ratings.csv", index=False)
    pandas_movies.to_csv(csv / "movies.csv", index=False)
    prepare.main(["--csv-dir", str(csv), "--out", str(tmp_path / "processed"), "--cf", "2", "2", "--content", "2", "1", "--by-user"])
    kept = io.load_processed(spark, str(tmp_path / "processed"))[1].count()
    assert kept > 0 and bucketed.open_bucketed(spark, str(tmp_path / "processed" / io.BY_USER)).count() == kept
    build_all.main(["--processed", str(tmp_path / "processed"), "--out", str(tmp_path / "models")])
    assert model_store.load_cf_model(spark, str(tmp_path / "models/knn_cf"))["items"].count() > 0
    leave_last_out.main(["--processed", str(tmp_path / "processed"), "--out", str(tmp_path / "llo"), "--sample", "5", "--k", "4",
                         "--sizes", "2", "5"])
    row = spark.read.option("header", True).csv(str(tmp_path / "llo/cf_eval_scores")).first()
    assert row["HR_at_4"] is not None
    sizes = spark.read.option("header", True).csv(str(tmp_path / "llo/cf_eval_sizes")).collect()
    assert sorted(int(r["sample_size"]) for r in sizes) == [2, 5] and all(float(r["elapsed_s"]) > 0 for r in sizes)
    assert {r["HR_at_4"] for r in sizes if r["sample_size"] == "5"} == {row["HR_at_4"]}
