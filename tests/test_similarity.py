import numpy as np
from conftest import ratings_df

from sparkrec.operators import similarity, tiles


def brute_cosine(rows):
    users = sorted({r[0] for r in rows})
    items = sorted({r[1] for r in rows})
    m = np.zeros((len(users), len(items)))
    for u, i, v in rows:
        m[users.index(u), items.index(i)] = v
    n = np.linalg.norm(m, axis=0)
    s = (m.T @ m) / np.outer(n, n)
    return items, s


def sample_rows(seed=7, n_users=40, n_items=30, heavy_user=True):
    rng = np.random.default_rng(seed)
    rows = set()
    for u in range(n_users):
        for i in rng.choice(n_items, size=rng.integers(1, 8), replace=False):
            rows.add((u, int(i), float(rng.integers(1, 11)) / 2))
    if heavy_user:  # one user rates every item
        rows |= {(999, i, 3.0) for i in range(n_items)}
    d = {}
    for u, i, v in rows:
        d[(u, i)] = v
    return [(u, i, v) for (u, i), v in d.items()]


def collect_sims(df):
    return {(r.i, r.j): r.sim for r in df.collect()}


def test_cosine_matches_brute_force_both_paths(spark):
    rows = sample_rows()
    items, s = brute_cosine(rows)
    r = ratings_df(spark, rows, with_ts=False)
    one_group = collect_sims(tiles.cosine_pairs(r, "userId", "movieId", "rating"))
    # tiny tiles force several row-groups (partial sums added by an aggregate)
    many_groups = collect_sims(tiles.cosine_pairs(r, "userId", "movieId", "rating", tile_entries=20))
    for got in (one_group, many_groups):
        for a_idx, a in enumerate(items):
            for b_idx, b in enumerate(items):
                if a == b or s[a_idx, b_idx] <= 0:
                    assert (a, b) not in got
                else:
                    assert abs(got[(a, b)] - s[a_idx, b_idx]) < 1e-9


def test_top_k_neighbours(spark):
    rows = sample_rows(seed=3)
    items, s = brute_cosine(rows)
    r = ratings_df(spark, rows, with_ts=False)
    top = similarity.item_similarity(r, 5).collect()
    by_item = {}
    for x in top:
        by_item.setdefault(x.movieId, []).append((x.rank, x.neighborId, x.sim))
    for a_idx, a in enumerate(items):
        expect = sorted(((-round(s[a_idx, b_idx], 8), b) for b_idx, b in enumerate(items)
                         if b != a and s[a_idx, b_idx] > 0))[:5]
        got = [n for _, n, _ in sorted(by_item.get(a, []))]
        assert got == [b for _, b in expect]
        assert all(0 < sim <= 1 + 1e-9 for _, _, sim in by_item.get(a, []))
        assert a not in got


def test_full_matrix_includes_self(spark):
    r = ratings_df(spark, [(1, 1, 4.0), (1, 2, 2.0), (2, 1, 1.0)], with_ts=False)
    full = {(x.movieId, x.neighborId): x.sim for x in similarity.item_similarity(r, None).collect()}
    assert full[(1, 1)] == 1.0 and full[(2, 2)] == 1.0 and (1, 2) in full


def test_plan_tiles_bounds():
    nb, p = tiles.plan_tiles(n_cols=100_000, n_entries=10**9, parallelism=1000)
    assert nb <= tiles.MAX_BLOCKS and p > 1
    nb, p = tiles.plan_tiles(n_cols=50, n_entries=500, parallelism=8)
    assert p == 1 and nb * (nb + 1) // 2 >= 16


def test_sparse_accumulator_path(spark):
    """Blocks too big for a dense accumulator take the sparse path; results are identical."""
    rows = sample_rows(seed=11)
    items, s = brute_cosine(rows)
    r = ratings_df(spark, rows, with_ts=False)
    for kw in ({"max_acc_cells": 4}, {"max_acc_cells": 4, "tile_entries": 20}):
        got = collect_sims(tiles.cosine_pairs(r, "userId", "movieId", "rating", **kw))
        for a_idx, a in enumerate(items):
            for b_idx, b in enumerate(items):
                if a != b and s[a_idx, b_idx] > 0:
                    assert abs(got[(a, b)] - s[a_idx, b_idx]) < 1e-9
                else:
                    assert (a, b) not in got
        top = tiles.cosine_pairs(r, "userId", "movieId", "rating", top_k=3, max_acc_cells=4)
        dense_top = tiles.cosine_pairs(r, "userId", "movieId", "rating", top_k=3)
        def ranked(df):
            df = df.withColumnRenamed("i", "movieId").withColumnRenamed("j", "neighborId")
            return {(x.movieId, x.neighborId, x.rank) for x in similarity.top_neighbours(df, 3).collect()}

        assert ranked(top) == ranked(dense_top)


def test_similar_items_and_unknown(spark):
    r = ratings_df(spark, [(1, 1, 4.0), (1, 2, 5.0), (2, 1, 3.0), (2, 3, 4.0)], with_ts=False)
    sim = similarity.item_similarity(r, 10)
    q = spark.createDataFrame([(1,), (999,)], "movieId long")
    got = [(x.query_movieId, x.movieId) for x in similarity.similar_items(sim, q, 1).collect()]
    assert len(got) == 1 and got[0][0] == 1
    assert [x.movieId for x in similarity.unknown_items(r.select("movieId"), q).collect()] == [999]


def test_list_as_long_as_the_catalog_is_the_full_matrix(spark):
    r = ratings_df(spark, [(1, 1, 4.0), (1, 2, 5.0), (2, 1, 3.0), (2, 3, 4.0)], with_ts=False)
    full = {(x.movieId, x.neighborId) for x in similarity.item_similarity(r, 3).collect()}
    assert full == {(1, 1), (2, 2), (3, 3), (1, 2), (2, 1), (1, 3), (3, 1)}
    assert all(x.movieId != x.neighborId for x in similarity.item_similarity(r, 2).collect())
