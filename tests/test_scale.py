"""Results that must not depend on layout, and code that must run off the repository."""

import os
import subprocess
import sys

import pytest
from conftest import movies_df, ratings_df

from sparkrec.operators import blend, clean, content, eda, evaluate, stats, tiles

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_tile_layouts_rank_alike(spark):
    """One row group, several row groups and small tiles give the same ranked neighbours on data full of ties."""
    rows = [(u, m, 1.0 + (u * m) % 2) for u in range(40) for m in range(25) if (u + m) % 3]
    entries = spark.createDataFrame(rows, "r long, c long, v double")
    found = []
    for size in (10 ** 6, 400, 60):
        pairs = tiles.cosine_pairs(entries, "r", "c", "v", top_k=4, tile_entries=size).collect()
        ranked = {}
        for x in sorted(pairs, key=lambda x: (x["i"], -x["sim_r"], x["j"])):
            ranked.setdefault(x["i"], []).append((x["j"], round(x["sim_r"], 8)))
        found.append({i: v[:4] for i, v in ranked.items()})
    assert found[0] == found[1] == found[2]


def test_filter_reports_passes(spark):
    rows = [(u, m, 3.0) for u in range(6) for m in range(u, 6)] + [(u, m, 4.0) for u in range(20, 25) for m in range(20, 25)]
    res = clean.activity_filter(ratings_df(spark, rows), min_user=4, min_movie=4)
    assert res.converged and res.passes > 1
    assert {r["userId"] for r in res.ratings.collect()} == set(range(20, 25))


def test_orphan_only_user_gets_an_empty_list(spark):
    ratings = ratings_df(spark, [(u, m, 4.5) for u in range(5) for m in (1, 2)] + [(u, 3, 5.0) for u in range(1, 5)], with_ts=False)
    movies = movies_df(spark, [(1, "A (2000)", "Drama"), (2, "B (2001)", "Drama")])
    sim = spark.createDataFrame([(1, 3, 0.5, 1)], "movieId long, neighborId long, sim double, rank int")
    weights = spark.createDataFrame([], "movieId long, term string, weight double")
    users = spark.createDataFrame([(0,), (77,)], "userId long")
    got = blend.predict(users, ratings, movies, ratings, sim, weights, k=2, alpha=1.0).collect()
    assert {r["userId"] for r in got} == {77}
    recommended = spark.createDataFrame([(0, 3), (1, 3), (1, 2)], "userId long, movieId long")
    assert [tuple(r) for r in blend.orphans(recommended, movies).collect()] == [(3, 2)]


def test_empty_evaluation_and_sparsity(spark):
    none = evaluate._hit_summary(spark.createDataFrame([], "userId long, draw_rank int, status string, hit double, ndcg double"))
    row = none.first()
    assert (row["users_evaluated"], row["HR_at_10_all"], row["NDCG_at_10_all"], row["n_missing_truth"]) == (0, 0.0, 0.0, 0)
    some = spark.createDataFrame([(1, 1, "ok", None, None), (2, 2, "ok", 1.0, 1.0)],
                                 "userId long, draw_rank int, status string, hit double, ndcg double")
    assert evaluate._hit_summary(some).first()["n_missing_truth"] == 1
    assert eda.sparsity(ratings_df(spark, [])).first()["n_ratings"] == 0


JOB = """
import sys
sys.path.insert(0, sys.argv[1])
from sparkrec.session import get_spark
spark = get_spark(shuffle_partitions=None)
assert spark.sparkContext.master == "local[2]" and spark.conf.get("spark.sql.shuffle.partitions") == "7"
import __spark_entry__ as entry
print("rows", entry.queries()["item_similarity_top20"](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_runs_from_a_foreign_folder_with_submitted_settings(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(JOB)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYSPARK_SUBMIT_ARGS"] = ("--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=7 "
                                  f"--conf spark.checkpoint.dir={tmp_path} pyspark-shell")
    done = subprocess.run([sys.executable, str(script), ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=280)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_resolver_picks_the_rarest_gram(spark):
    """Most titles share their first words; short, empty and over-long queries keep their defined results."""
    titles = [(i, f"The Return {i:03d} (19{i % 90 + 10})", "Drama") for i in range(90)]
    titles += [(200, "The Zebra (1999)", "Drama"), (201, "Q", "Drama"), (202, "The Zebra", "Drama")]
    found = {}
    queries = ["the zebra", "the return 04", "q", "", "zzz", "the zebra (1999) and more", "TURN 089"]
    asked = spark.createDataFrame([(x,) for x in queries], "query string")
    for r in content.resolve_titles(asked, movies_df(spark, titles)).collect():
        found[r["query"]] = (r["movieId"], r["method"])
    assert found == {"the zebra": (200, "contains"), "the return 04": (40, "contains"), "q": (201, "contains"),
                     "": (None, "unresolved"), "zzz": (None, "unresolved"),
                     "the zebra (1999) and more": (None, "unresolved"), "TURN 089": (89, "contains")}


def test_popular_recs_with_a_user_who_saw_most(spark, monkeypatch):
    monkeypatch.setattr(stats, "RANK_CHUNK", 4)
    rows = [(1, m, 4.0) for m in range(30)] + [(u, m, 5.0) for u in range(2, 20) for m in range(u % 5, 33, 5)]
    train = ratings_df(spark, rows, with_ts=False)
    ranked = stats.ranked_popularity(stats.popular_ranking(train))
    order = [r["movieId"] for r in ranked.orderBy("pop_rank").collect()]
    users = spark.createDataFrame([(u,) for u in [*range(1, 20), 99]], "userId long")
    got = {}
    for r in stats.popular_recs(users, train, ranked, 5).collect():
        got.setdefault(r["userId"], {})[r["rank"]] = r["movieId"]
    for u in [*range(1, 20), 99]:
        seen = {m for v, m, _ in rows if v == u}
        assert got.get(u, {}) == dict(enumerate([m for m in order if m not in seen][:5], 1))


def test_pairs_asked_for_and_counts(spark):
    rows = [(u, m, 1.0 + u % 3) for u in range(12) for m in range(8) if (u * m) % 3]
    entries = ratings_df(spark, rows, with_ts=False)
    every = {(r["i"], r["j"]): r["sim"] for r in tiles.cosine_pairs(entries, "userId", "movieId", "rating").collect()}
    asked = spark.createDataFrame([(1, 2), (2, 1), (1, 4), (0, 1), (5, 99)], "a long, b long")
    got = {(r["a"], r["b"]): r["sim"] for r in tiles.cosine_of(asked, entries, "userId", "movieId", "rating").collect()}
    assert set(got) == {p for p in [(1, 2), (2, 1), (1, 4), (0, 1), (5, 99)] if p in every}
    assert all(abs(got[p] - every[p]) < 1e-12 for p in got)
    liked = entries.withColumn("rating", entries["rating"] + 3)
    one = {(r["query_movieId"], r["rank"]): (r["movieId"], r["n_users"]) for r in eda.co_liked(liked, 2).collect()}
    by_user = {u: {m for v, m, _ in rows if v == u} for u in range(12)}
    for m in range(8):
        counts = sorted((-sum({m, o} <= s for s in by_user.values()), o) for o in range(8) if o != m)
        want = [(o, -c) for c, o in counts if c][:2]
        assert [one[m, k] for k in (1, 2) if (m, k) in one] == want
