import pytest
from conftest import ratings_df

from sparkrec.operators import split


def test_time_split_sizes(spark):
    rows = []
    for n, u in ((1, 1), (2, 2), (5, 3), (10, 4)):
        rows += [(u, m, 4.0, 100 + m) for m in range(n)]
    r = ratings_df(spark, rows)
    train, test = split.time_split(r, 0.2, 1)
    n_test = {u: 0 for u in (1, 2, 3, 4)}
    for x in test.collect():
        n_test[x.userId] += 1
    assert n_test == {1: 0, 2: 1, 3: 1, 4: 2}
    assert train.count() + test.count() == r.count()
    assert train.join(test, ["userId", "movieId"]).count() == 0
    last = {x.movieId for x in test.filter("userId = 4").collect()}
    assert last == {8, 9}
    with pytest.raises(ValueError):
        split.time_split(r, 1.0)


def test_time_split_ties_order_independent(spark):
    a = ratings_df(spark, [(1, 5, 4.0, 100), (1, 3, 4.0, 100), (1, 9, 4.0, 50)])
    b = ratings_df(spark, [(1, 3, 4.0, 100), (1, 9, 4.0, 50), (1, 5, 4.0, 100)])
    ta = {x.movieId for x in split.time_split(a, 0.2)[1].collect()}
    tb = {x.movieId for x in split.time_split(b, 0.2)[1].collect()}
    assert ta == tb == {5}


def test_heavy_user_positions(spark):
    # one user owning most rows: positions still exact
    rows = [(1, m, 3.0, m) for m in range(500)] + [(2, m, 3.0, m) for m in range(5)]
    train, test = split.time_split(ratings_df(spark, rows), 0.2)
    t1 = sorted(x.movieId for x in test.filter("userId = 1").collect())
    assert t1 == list(range(400, 500))


def test_leave_last_out(spark):
    r = ratings_df(spark, [(1, 1, 4.0, 10), (1, 2, 4.0, 20), (1, 3, 4.0, 20), (2, 7, 3.0, 5)])
    train, test = split.leave_last_out(r)
    assert {(x.userId, x.movieId) for x in test.collect()} == {(1, 3), (2, 7)}
    assert {(x.userId, x.movieId) for x in train.collect()} == {(1, 1), (1, 2)}


def test_leave_last_out_joins_once_and_keeps_null_and_repeated_keys(spark):
    r = ratings_df(spark, [(1, 1, 4.0, 10), (1, 2, 4.0, 20), (1, 2, 4.0, 20), (None, 5, 3.0, 7), (2, None, 3.0, 9), (2, 4, 2.0, 1)])
    train, test = split.leave_last_out(r)
    assert sorted(x.movieId for x in test.collect()) == [2, 2]
    assert {(x.userId, x.movieId) for x in train.collect()} == {(1, 1), (None, 5), (2, None), (2, 4)}
    for part in (train, test):  # both read what one join wrote
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan


def test_time_split_is_placed_once_and_read_from_there(spark):
    train, test = split.time_split(ratings_df(spark, [(u, m, 4.0, m) for u in range(5) for m in range(10)]))
    assert (train.count(), test.count()) == (40, 10)
    for part in (train, test):  # no part joins the positions again
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
