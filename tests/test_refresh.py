"""Refreshed similarity against a full rebuild."""

import uuid

import numpy as np
import pytest
from conftest import ratings_df

from sparkrec.operators import refresh, similarity
from sparkrec.session import ensure_checkpoint_dir
from sparkrec.sources import model_store


def rows_of(sims):
    return sorted((r["movieId"], r["rank"], r["neighborId"], round(r["sim"], 7)) for r in sims.collect())


def random_ratings(rng, users=60, items=40):
    return {(u, int(m)): float(rng.integers(1, 11)) / 2 for u in range(users) for m in rng.choice(items, 6, replace=False)}


@pytest.mark.parametrize("seed, k", [(1, 5), (2, 3), (3, 12)])
def test_refresh_equals_rebuild(spark, seed, k):
    rng = np.random.default_rng(seed)
    old = random_ratings(rng)
    new = dict(old)
    for key in [x for x in old if x[1] in (3, 17)][::2]:      # changed ratings of two items
        new[key] = 5.5 - new[key] if new[key] != 2.75 else 1.0
    new = {x: v for x, v in new.items() if x[1] != 9}         # a removed item
    new.update({(u, 99): 4.0 for u in range(0, 60, 7)})       # an added item
    frames = [ratings_df(spark, [(u, m, v) for (u, m), v in x.items()], with_ts=False) for x in (old, new)]
    before = similarity.item_similarity(frames[0], k)
    got, again = refresh.refresh_similarity(before, refresh.item_digests(frames[0]), frames[1], k)
    assert rows_of(got) == rows_of(similarity.item_similarity(frames[1], k))
    redone = {r["movieId"] for r in again.collect()}
    assert {3, 17, 99} <= redone and 9 not in redone
    same, none = refresh.refresh_similarity(before, refresh.item_digests(frames[0]), frames[0], k)
    assert rows_of(same) == rows_of(before) and none.isEmpty()


def test_refreshed_model_is_committed(spark):
    rng = np.random.default_rng(4)
    old = random_ratings(rng, 30, 20)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-refresh/{uuid.uuid4().hex}"
    first = ratings_df(spark, [(u, m, v) for (u, m), v in old.items()], with_ts=False)
    model_store.save_refreshable(first, similarity.item_similarity(first, 4), path)
    old[(3, 5)] = 0.5 if old.get((3, 5)) != 0.5 else 5.0
    second = ratings_df(spark, [(u, m, v) for (u, m), v in old.items()], with_ts=False)
    assert 1 <= model_store.refresh_cf_model(spark, second, path, 4) <= 20
    model = model_store.load_cf_model(spark, path, expected_n_ratings=len(old))
    assert rows_of(model["similarity"]) == rows_of(similarity.item_similarity(second, 4))
    assert model_store.refresh_cf_model(spark, second, path, 4) == 0
