import uuid

import pytest
from conftest import ratings_df

from sparkrec.operators import similarity
from sparkrec.session import ensure_checkpoint_dir
from sparkrec.sources import io, model_store, stage_store


def model(spark):
    r = ratings_df(spark, [(1, 1, 4.0), (1, 2, 5.0), (2, 1, 3.0), (2, 3, 4.0), (3, 2, 2.0)], with_ts=False)
    return r, similarity.item_similarity(r, 100)


def path(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-models/{uuid.uuid4().hex}"


def test_roundtrip_and_refusals(spark):
    r, sim = model(spark)
    p = path(spark)
    model_store.save_cf_model(r, sim, p)
    t = model_store.load_cf_model(spark, p, expected_n_ratings=5)
    assert t["meta"].first().n_items == 3
    with pytest.raises(ValueError):
        model_store.load_cf_model(spark, p, expected_n_ratings=6)
    # a different catalog under the same meta -> fingerprint refusal
    folder = stage_store.current_folder(spark, p)
    spark.createDataFrame([(1,), (2,), (4,)], "movieId long").write.mode("overwrite").parquet(f"{folder}/items")
    with pytest.raises(ValueError):
        model_store.load_cf_model(spark, p)
    with pytest.raises(FileNotFoundError):
        model_store.load_cf_model(spark, path(spark))


def test_missing_meta_refused(spark):
    r, sim = model(spark)
    p = path(spark)
    model_store.save_cf_model(r, sim, p)
    import shutil
    shutil.rmtree(stage_store.current_folder(spark, p).replace("file:", "") + "/meta")
    with pytest.raises(ValueError):
        model_store.load_cf_model(spark, p)


def test_fingerprint_order_free(spark):
    a = spark.createDataFrame([(3,), (1,), (2,)], "movieId long")
    b = spark.createDataFrame([(1,), (2,), (3,), (3,)], "movieId long")
    assert model_store.fingerprint(a).first() == model_store.fingerprint(b).first()
    c = spark.createDataFrame([(1,), (2,), (4,)], "movieId long")
    assert model_store.fingerprint(a).first() != model_store.fingerprint(c).first()


def test_missing_inputs_named(spark):
    with pytest.raises(FileNotFoundError) as e:
        io.check_inputs(spark, {"a": "/nonexistent/a.parquet", "b": "/nonexistent/b.parquet"})
    assert "a (" in str(e.value) and "b (" in str(e.value)


def test_alias_drift(spark):
    r, _ = model(spark)
    assert io.alias_drift(r, r).count() == 0
    assert io.alias_drift(r, r.limit(4)).count() == 1


def test_a_writer_that_stops_leaves_the_old_model(spark):
    r, sim = model(spark)
    p = path(spark)
    first = model_store.save_cf_model(r, sim, p)

    def broken(folder):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        stage_store.commit_tables(spark, {"interactions": r.limit(1), "similarity": sim.limit(1), "items": broken}, p)
    t = model_store.load_cf_model(spark, p, expected_n_ratings=5)
    assert t["similarity"].count() == sim.count() and stage_store.current_folder(spark, p).endswith(first)
    more = ratings_df(spark, [(9, 1, 4.0), (9, 2, 5.0)], with_ts=False)
    second = model_store.save_cf_model(more, similarity.item_similarity(more, 100), p)
    assert second != first and model_store.load_cf_model(spark, p, expected_n_ratings=2)["meta"].first().n_users == 1
    assert t["users"].count() == 3                       # a reader of the old version still has its files
    assert stage_store.drop_old_versions(spark, p) == 2  # the old model and the broken write
    assert model_store.load_cf_model(spark, p)["items"].count() == 2


def test_bundles_are_committed_together(spark):
    p = path(spark)
    with pytest.raises(FileNotFoundError):
        model_store.load_bundle(spark, p, "a")
    model_store.save_bundle({"a": spark.range(3), "b": spark.range(4)}, p)
    model_store.save_bundle({"a": spark.range(5), "b": spark.range(6)}, p)
    assert [df.count() for df in model_store.load_bundle(spark, p, "a", "b").values()] == [5, 6]


def test_changed_input_builds_again(spark):
    p = path(spark)
    spark.range(5).write.parquet(f"{p}/a.parquet")
    spark.range(7).write.parquet(f"{p}/b.parquet")
    cache, made = stage_store.VersionedCache(), []

    def get(name):
        folder = f"{p}/{name}.parquet"
        return cache.get(spark, (name,), [folder], lambda: made.append(name) or spark.read.parquet(folder).count())

    assert (get("a"), get("b"), get("a")) == (5, 7, 5) and made == ["a", "b"]
    spark.range(2).write.mode("append").parquet(f"{p}/a.parquet")
    assert (get("a"), get("b"), get("a")) == (7, 7, 7) and made == ["a", "b", "a"]


def test_queries_notice_a_changed_table(spark, tmp_path):
    from sparkrec.plans import common

    line = "l_orderkey long, l_partkey long, l_quantity double, l_linenumber int"
    spark.createDataFrame([(1, 7, 20.0, 1)], line).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT 1L AS o_orderkey, 3L AS o_custkey, timestamp_ntz'2020-01-01 00:00:00' AS o_orderdate").write.parquet(
        str(tmp_path / "orders.parquet"))
    assert [r["movieId"] for r in common.ratings(spark, str(tmp_path)).collect()] == [7]
    same = common.ratings(spark, str(tmp_path))
    assert same is common.ratings(spark, str(tmp_path))
    spark.createDataFrame([(1, 8, 20.0, 1)], line).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert [r["movieId"] for r in common.ratings(spark, str(tmp_path)).collect()] == [8]


def test_a_restarted_job_goes_on(spark):
    p = path(spark)
    spark.range(5).write.parquet(f"{p}/in.parquet")

    def lost():
        raise RuntimeError("lost")

    def job(stop=False):
        store = stage_store.StageStore(spark, f"{p}/stages")
        a = store.stage("double", lambda: spark.read.parquet(f"{p}/in.parquet").selectExpr("2 * id AS x"), paths=[f"{p}/in.parquet"])
        if stop:
            with pytest.raises(RuntimeError):
                store.stage("sum", lost, after=[a])
            return None, store.made
        b = store.stage("sum", lambda: a.frame.selectExpr("sum(x) AS s"), params=[1], after=[a])
        return b.frame.first()["s"], store.made

    assert job(stop=True) == (None, ["double"])
    assert job() == (20, ["sum"])
    assert job() == (20, [])
    spark.range(1).write.mode("append").parquet(f"{p}/in.parquet")
    assert job() == (20, ["double", "sum"])


def test_csv_lines_that_do_not_fit(spark, tmp_path):
    good = "userId,movieId,rating,timestamp\n1,2,4.5,100\n1,3,2.0,101\n"
    (tmp_path / "good.csv").write_text(good)
    (tmp_path / "bad.csv").write_text(good + "x,4,3.0,102\n2,5,abc,103\n3,6,4.0\n4,,1.0,104\n5,7,3.5,105,extra\n6,8,1.5,106\n")
    assert io.load_ratings_raw(spark, str(tmp_path / "good.csv")).count() == 2
    with pytest.raises(ValueError, match="x,4,3.0,102"):
        io.load_ratings_raw(spark, str(tmp_path / "bad.csv"))
    kept = io.load_ratings_raw(spark, str(tmp_path / "bad.csv"), "quarantine", str(tmp_path / "rejects"))
    assert sorted(r["movieId"] for r in kept.collect()) == [2, 3, 8]
    found = spark.read.parquet(str(tmp_path / "rejects")).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in found} == {"malformed line": 4, "missing movieId": 1}
    assert io.load_ratings_raw(spark, str(tmp_path / "bad.csv"), "drop").count() == 3
    (tmp_path / "movies.csv").write_text('movieId,title,genres\n1,"A, ""B"" (2000)",Drama|Comedy\nq,C (2001),Drama\n2,D (2002),\n')
    with pytest.raises(ValueError, match="q,C"):
        io.load_movies_raw(spark, str(tmp_path / "movies.csv"))
    movies = io.load_movies_raw(spark, str(tmp_path / "movies.csv"), "drop").orderBy("movieId").collect()
    assert [(m["movieId"], m["title"], m["genres"]) for m in movies] == [(1, 'A, "B" (2000)', "Drama|Comedy"), (2, "D (2002)", None)]
    (tmp_path / "wide.csv").write_text("timestamp,tag,rating,movieId,userId\n\n100,x,4.5,2,1\n")
    assert [tuple(r) for r in io.load_ratings_raw(spark, str(tmp_path / "wide.csv")).collect()] == [(1, 2, 4.5, 100)]
    with pytest.raises(ValueError, match="no column userId, rating"):
        io.load_ratings_raw(spark, str(tmp_path / "movies.csv"))
    with pytest.raises(FileNotFoundError):
        io.load_movies_raw(spark, str(tmp_path / "none.csv"))
