"""Sketches against exact figures, whole and merged from parts."""

from conftest import ratings_df
from pyspark.sql import functions as F

from sparkrec.operators import sketches, stats


def test_merged_parts_are_close_to_exact(spark):
    rows = [(u % 3000, (u * 7919) % 1700, 0.5 + (u % 10) / 2, u) for u in range(20000)]
    ratings = ratings_df(spark, rows).repartition(7)
    parts = sketches.activity_sketches(ratings, F.col("timestamp") % 12)
    assert parts.count() == 12
    exact = (20000, len({r[0] for r in rows}), len({r[1] for r in rows}))
    values = sorted(r[2] for r in rows)
    for found in (sketches.figures(sketches.merged(parts)).first(), sketches.figures(sketches.activity_sketches(ratings, F.lit(1))).first()):
        assert found["n_ratings"] == exact[0]
        assert abs(found["n_users"] / exact[1] - 1) < 0.05 and abs(found["n_movies"] / exact[2] - 1) < 0.05
        assert abs(found["density"] / (exact[0] / exact[1] / exact[2]) - 1) < 0.1
        for q in sketches.QUANTILES:
            at = found[f"q{round(100 * q)}"]
            assert sum(v < at for v in values) / len(values) <= q + 0.03 and sum(v <= at for v in values) / len(values) >= q - 0.03


def test_new_parts_are_added_without_the_old_rows(spark):
    old = ratings_df(spark, [(u, m, 3.0, 1) for u in range(50) for m in range(10)])
    new = ratings_df(spark, [(u, m, 4.0, 2) for u in range(40, 90) for m in range(5, 15)])
    kept = sketches.activity_sketches(old, F.col("timestamp"))
    both = sketches.merged(kept.unionByName(sketches.activity_sketches(new, F.col("timestamp"))))
    row = sketches.figures(both).first()
    assert (row["n_ratings"], row["n_users"], row["n_movies"]) == (1000, 90, 15)  # so few are counted exactly
    halves = sketches.figures(sketches.merged(kept, F.col("part") % 2)).collect()
    assert [(r["part"], r["n_users"]) for r in halves] == [(1, 50)]


def test_popular_lists_do_not_depend_on_the_copies(spark, monkeypatch):
    train = ratings_df(spark, [(u, m, 5.0) for u in range(30) for m in range(u % 7, 40, 1 + u % 5)], with_ts=False)
    users = train.select("userId").distinct()
    ranked = stats.ranked_popularity(stats.popular_ranking(train, 4.0))
    found = []
    for chunk, share in ((1024, 1024), (4, 3), (8, 1)):
        monkeypatch.setattr(stats, "RANK_CHUNK", chunk)
        monkeypatch.setattr(stats, "CHUNK_USERS", share)
        found.append(sorted(map(tuple, stats.popular_recs(users, train, ranked, 5).collect())))
    assert found[0] == found[1] == found[2] and found[0]
