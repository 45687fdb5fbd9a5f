"""Block-max pruning and the reduce of split row-groups."""

import numpy as np
from conftest import ratings_df

from sparkrec.operators import profile, pruned, tiles


def vectors(rng, n, terms, groups):
    """Vectors whose terms lie mostly in one of ``groups`` ranges."""
    out = []
    for a in range(n):
        base = int(rng.integers(groups)) * (terms // groups)
        t = sorted({base + int(x) for x in rng.integers(0, terms // groups, 6)} | ({int(rng.integers(terms))} if rng.random() < 0.2 else set()))
        out.append((a, t, [float(round(x, 3)) for x in rng.random(len(t)) + 0.05]))
    return out


def cosine(x, y):
    dot = sum(v * dict(zip(*y)).get(t, 0.0) for t, v in zip(*x))
    return dot / (np.linalg.norm(x[1]) * np.linalg.norm(y[1]))


def test_pruned_scores_hold_every_list_with_fewer_copies(spark):
    rng = np.random.default_rng(2)
    users, items = vectors(rng, 90, 120, 12), vectors(rng, 300, 120, 12)
    need, size = 7, [int(x) for x in rng.integers(1, 3, len(items))]
    left = spark.createDataFrame([(*u, need) for u in users], "a long, t array<long>, v array<double>, n long")
    right = spark.createDataFrame([(*i, s) for i, s in zip(items, size)], "a long, t array<long>, v array<double>, n long")
    scores, rounds = pruned.score_rounds(left, right, len(users), len(items), item_block=10, user_block=20)
    got: dict = {}
    for r in scores.collect():
        assert (r["u"], r["i"]) not in got
        got[r["u"], r["i"]] = r["score_r"]
    for u, t, v in users:
        ranked = sorted(((round(cosine((t, v), (ti, vi)), 8), i) for i, ti, vi in items), key=lambda x: (-x[0], x[1]))
        before, level = 0, None
        for s, i in ranked:
            if s <= 0:
                break
            if s != level and before >= need:
                break
            level, before = s, before + size[i]
            assert abs(got[u, i] - s) < 2e-8
    copies = sum(r.count() for r in rounds)
    meetings = sum(r.filter("side = 0").count() for r in rounds)
    vectors_sent = sum(r.filter("side = 1").count() for r in rounds)
    blocks = len(items) // 10
    assert meetings < len(users) * blocks / 3                  # most (user, block) pairs are pruned
    assert vectors_sent <= meetings + 2 * len(items)           # vectors follow the meetings ..
    assert copies < len(users) * blocks + len(items) * -(-len(users) // 20)  # .. and not users times vectors


def test_lists_do_not_depend_on_the_block_size(spark):
    rng = np.random.default_rng(3)
    weights = spark.createDataFrame([(a, f"t{t}", v) for a, ts, vs in vectors(rng, 80, 40, 5) for t, v in zip(ts, vs)],
                                    "movieId long, term string, weight double")
    ratings = ratings_df(spark, [(u, int(m), 4.0 + float(m % 2)) for u in range(15) for m in rng.choice(80, 6, replace=False)])
    found = [sorted((r["userId"], r["movieId"], round(r["score"], 7), r["rank"])
                    for r in profile.ranked_content(ratings, weights, 9, item_block=b).collect()) for b in (4096, 8, 1)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 15 * 9


def test_split_row_groups_shuffle_no_pair_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(int(u), int(m), float(rng.integers(1, 10)) / 2) for u in range(50) for m in rng.choice(40, 9, replace=False)]
    entries = spark.createDataFrame(rows, "r long, c long, v double")
    for top_k, unit, cells in ((4, True, 10 ** 6), (None, True, 10 ** 6), (4, False, 10 ** 6), (4, True, 10)):
        whole = tiles.cosine_pairs(entries, "r", "c", "v", top_k, unit=unit)
        split = tiles.cosine_pairs(entries, "r", "c", "v", top_k, tile_entries=8, max_acc_cells=cells, unit=unit)
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Join" not in plan and plan.count("FlatMapGroupsInPandas") == 2

        def lists(df):
            out: dict = {}
            for x in sorted(df.collect(), key=lambda x: (x["i"], -round(x["sim"], 7), x["j"])):
                out.setdefault(x["i"], []).append((x["j"], round(x["sim"], 7)))
            return {i: v[:top_k] for i, v in out.items()}

        assert lists(whole) == lists(split)


def test_lists_share_one_shuffle_with_the_seen_movies(spark, monkeypatch):
    """Members of a class stay packed up to the shuffle by user, and users that would fill a task are dealt by movie."""
    terms = [("x", 1.0), ("y", 2.0), ("z", 0.5)]
    weights = spark.createDataFrame([(m, *terms[m % 3]) for m in range(60)] + [(m, "x", 0.1) for m in range(1, 60, 3)],
                                    "movieId long, term string, weight double")
    rows = [(1, m, 4.0) for m in range(45)] + [(2, 0, 5.0), (2, 4, 4.0), (2, 4, 4.0), (3, 59, 4.0), (3, None, 1.0), (None, 5, 4.0)]
    ratings = ratings_df(spark, rows, with_ts=False)

    def lists():
        return sorted((r["userId"], r["rank"], r["movieId"], round(r["score"], 9)) for r in profile.ranked_content(ratings, weights, 7).collect())

    whole = lists()
    seen = {(u, m) for u, m, _ in rows}
    by_user = {u: [x for x in whole if x[0] == u] for u in (1, 2, 3)}
    assert all(len(x) == 7 for x in by_user.values()) and len(whole) == 21
    assert not [x for x in whole if (x[0], x[2]) in seen]
    assert all(a[3] > b[3] or a[2] < b[2] for x in by_user.values() for a, b in zip(x, x[1:]))
    plan = profile.ranked_content(ratings, weights, 7)._jdf.queryExecution().sparkPlan().toString()
    assert not [x for x in plan.splitlines() if "LeftAnti" in x and "movieId" in x]
    for chunk, limit in ((4, 10 ** 6), (1024, 20), (3, 5)):
        monkeypatch.setattr(profile, "MEMBER_CHUNK", chunk)
        monkeypatch.setattr(profile, "LISTED_PER_TASK", limit)
        assert lists() == whole


def test_a_user_is_sent_once_to_the_blocks_it_meets(spark):
    """Blocks share tiles, so a user's vector is not copied to each small block; every meeting is scored, once."""
    rng = np.random.default_rng(5)
    users, items = vectors(rng, 60, 30, 2), vectors(rng, 200, 30, 2)
    left = spark.createDataFrame([(*u, 5) for u in users], "a long, t array<long>, v array<double>, n long")
    right = spark.createDataFrame([(*i, 1) for i in items], "a long, t array<long>, v array<double>, n long")
    scores, rounds = pruned.score_rounds(left, right, 60, 200, item_block=4, user_block=2048)
    first, second = (r.filter("side = 0").selectExpr("a", "size(blocks) n").collect() for r in rounds)
    assert len({r.a for r in second}) == len(second) <= 60 < sum(r.n for r in second)
    assert all(r.n == 1 for r in first)
    pairs = [(r.u, r.i) for r in scores.collect()]
    assert len(pairs) == len(set(pairs))
    many = pruned.meeting_rows(spark.createDataFrame([(u, b) for u in range(60) for b in (0, u % 8)], "a long, block long").distinct(),
                               left, spark.createDataFrame([(a, t, v, 1, a % 8) for a, t, v in items], "a long, t array<long>, v array<double>, n long, block long"),
                               user_block=3, group_blocks=8)
    tiles_met = {(r.g, r.uc, b) for r in many.filter("side = 0").collect() for b in r.blocks}
    assert {(r.g, r.uc, r.blocks[0]) for r in many.filter("side = 1").collect()} == tiles_met


def test_few_vectors_are_sorted_where_many_items_share_them(monkeypatch):
    """The vectors that a list can need, with sizes that differ: all of them and no others, few looked at."""
    rng = np.random.default_rng(6)
    r = np.round(rng.random((25, 200)), 2) * (rng.random((25, 200)) < 0.8)
    looked = []
    lexsort = np.lexsort
    monkeypatch.setattr(tiles.np, "lexsort", lambda keys: looked.append(len(keys[0])) or lexsort(keys))
    for size in (np.full(200, 50), rng.integers(1, 100, 200), np.where(np.arange(200) == 7, 9000, 1)):
        need = rng.integers(1, 120, 25)
        u, c = tiles._needed(r, r > 0, size, need)
        want = {(a, b) for a in range(25) for b in range(200) if r[a, b] > 0 and size[r[a] > r[a, b]].sum() < need[a]}
        assert set(zip(u.tolist(), c.tolist())) == want and len(u) == len(want)
    assert looked[0] < 25 * 20
