import math

import pytest
from conftest import movies_df, ratings_df

from sparkrec.operators import clean


def test_year_genres(spark):
    m = movies_df(spark, [(1, "Toy Story (1995)", "Adventure|Animation"), (2, "Hamlet (1996) (TV)", None),
                          (3, "No Year", "(no genres listed)"), (4, "Alien (1979) ", "Sci-Fi||Horror")])
    got = {r.movieId: r for r in clean.clean_movies(m).collect()}
    assert got[1].year == 1995 and got[1].genres_list == ["Adventure", "Animation"]
    assert got[1].genres_text == "Adventure Animation"
    assert got[2].year is None and got[2].genres_list == []          # D6: later parentheses -> no year
    assert got[3].year is None and got[3].genres_list == [] and got[3].genres_text == ""
    assert got[4].year == 1979 and got[4].genres_list == ["Sci-Fi", "Horror"]


def test_dedup_latest_wins(spark):
    r = ratings_df(spark, [(1, 10, 2.0, 100), (1, 10, 5.0, 300), (1, 10, 3.0, 200), (2, 10, 1.0, 5),
                           (2, 10, 4.0, 5)])
    got = {(x.userId, x.movieId): (x.rating, x.timestamp) for x in clean.dedup_latest(r).collect()}
    assert got[(1, 10)] == (5.0, 300)
    assert got[(2, 10)] == (4.0, 5)    # tie on timestamp -> higher rating (D3)


def test_valid_range_drops_nan(spark):
    r = ratings_df(spark, [(1, 1, 0.0), (1, 2, 0.5), (1, 3, 5.0), (1, 4, 5.5), (1, 5, math.nan)])
    assert sorted(x.movieId for x in clean.valid_range(r).collect()) == [2, 3]


def test_activity_filter_fixpoint_and_empty(spark):
    rows = [(u, m, 4.0) for u in range(1, 6) for m in range(1, 6)] + [(9, 1, 4.0), (8, 99, 3.0)]
    r = ratings_df(spark, rows)
    res = clean.activity_filter(r, min_user=3, min_movie=3)
    got = {(x.userId, x.movieId) for x in res.ratings.collect()}
    assert got == {(u, m) for u in range(1, 6) for m in range(1, 6)}
    assert res.converged
    with pytest.raises(ValueError):
        clean.activity_filter(r, min_user=50, min_movie=50)


def test_activity_filter_cap_warns(spark):
    # a chain that loses one user and one movie per pass never stabilises within 2 passes
    rows = []
    for u in range(6):
        for m in range(u, 6):
            rows.append((u, m, 3.0))
    r = ratings_df(spark, rows)
    with pytest.warns(UserWarning):
        res = clean.activity_filter(r, min_user=3, min_movie=3, max_iter=1)
    assert res.passes == 1 and not res.converged


def test_guards(spark):
    from sparkrec.operators import similarity
    from sparkrec.schemas import guard_ratings, require_columns

    with pytest.raises(ValueError):
        guard_ratings(ratings_df(spark, []))
    with pytest.raises(ValueError):
        guard_ratings(ratings_df(spark, [(1, 1, math.nan)]))
    with pytest.raises(ValueError):
        require_columns(ratings_df(spark, [(1, 1, 4.0)]), ["userId", "genres"])
    with pytest.raises(ValueError):
        similarity.utility_matrix(ratings_df(spark, [(1, 1, 4.0, 1), (1, 1, 3.0, 2)]))
    two = ratings_df(spark, [(1, 1, 4.0), (1, 2, 3.0), (2, 1, 5.0)])
    assert similarity.build_cf_model(two, top_k=1)["similarity"].count() == 2
    assert similarity.build_cf_model(two)["similarity"].count() == 4   # longer than the catalog: with the diagonal


def test_peeling_reads_only_the_buckets_of_removed_ids(spark):
    # a dense core that stays, and a chain that loses one user and one movie per pass
    rows = [(u, m, 3.0) for u in range(100, 130) for m in range(100, 130)]
    rows += [(u, m, 3.0) for u in range(8) for m in (u, u + 1)] + [(0, 100, 2.0)]
    base = ratings_df(spark, rows)
    layout = clean.edge_layout(base, rows_per_bucket=20)
    assert layout.buckets == -(-len(rows) // 20)
    res = clean.activity_filter(base, 2, 2, layout=layout)
    want = {(u, m) for u, m, _ in rows}
    while True:
        movies = {m for m in {m for _, m in want} if sum(x == m for _, x in want) >= 2}
        step = {(u, m) for u, m in want if m in movies}
        users = {u for u in {u for u, _ in step} if sum(x == u for x, _ in step) >= 2}
        step = {(u, m) for u, m in step if u in users}
        if step == want:
            break
        want = step
    assert {(r["userId"], r["movieId"]) for r in res.ratings.collect()} == want
    assert res.converged and res.passes > 3
    assert all(a <= 2 and b <= 2 for a, b in res.read) and res.read[-1] == (0, 0)
    files = layout.edges(spark, "movieId", [0, 1]).inputFiles()
    assert all("bucket=0" in f or "bucket=1" in f for f in files)
    again = clean.activity_filter(base, 2, 2, layout=layout)
    assert again.ratings.count() == len(want)
