"""Row-wise top-k cosine (rowwise) and bounded tasks (session.spread)."""

import numpy as np
import pytest

from sparkrec import session
from sparkrec.operators import rowwise, tiles
from sparkrec.operators.ordering import group_position


def sparse_entries(spark, users=300, items=2000, per_user=12, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(u, int(c), float(rng.integers(1, 11)) / 2) for u in range(users) for c in rng.choice(items, per_user, replace=False)]
    rows += [(users + u, 7, 5.0) for u in range(40)]  # a popular column
    return rows, spark.createDataFrame(rows, "r long, c long, v double")


def brute(rows, k):
    at, norm = {}, {}
    for r, c, v in rows:
        at.setdefault(r, []).append((c, v))
        norm[c] = norm.get(c, 0.0) + v * v
    dot = {}
    for entries in at.values():
        for a, va in entries:
            for b, vb in entries:
                if a != b:
                    dot[a, b] = dot.get((a, b), 0.0) + va * vb
    best = {}
    for (a, b), d in dot.items():
        best.setdefault(a, []).append((-round(d / (norm[a] * norm[b]) ** 0.5, 8), b))
    return {(a, b) for a, found in best.items() for _, b in sorted(found)[:k]}


def test_sparse_tables_go_row_by_row_and_keep_exactly_the_best(spark):
    rows, e = sparse_entries(spark)
    found = tiles.cosine_pairs(e, "r", "c", "v", top_k=5)
    got = found.collect()
    assert {(x.i, x.j) for x in got} == brute(rows, 5)
    assert len(got) == len(brute(rows, 5))  # no more leave the tasks than the lists hold


def test_shipped_entries_follow_the_pairs_not_the_blocks(spark):
    rows, e = sparse_entries(spark)
    shipped = []
    for blocks in (64, 1024):
        out = e.repartition(4, "r").sortWithinPartitions("r", "c").selectExpr("r", "c", "v", "1D AS q").mapInArrow(
            rowwise._pack_task(blocks), rowwise.PACK_SCHEMA)
        shipped.append(out.groupBy().sum("entries").first()[0])
    assert max(shipped) <= 300 * 12 * 12 + 40  # every row at most once per entry of it


def test_packed_rows_come_back():
    size, cols = np.array([2, 1, 3]), np.array([5, 900, 7, -4, 0, 2**40], np.int64)
    values, squares = np.arange(6) / 3, np.arange(6.0) ** 2
    back = rowwise.unpack(rowwise.pack(size, cols, values, squares), 3, 6)
    assert all(np.array_equal(a, b) for a, b in zip(back, (size, cols, values, squares)))


@pytest.mark.parametrize("chunk", [1, 50, 10**6])
def test_chunks_hold_whole_columns(chunk):
    size, cols = np.array([3, 2]), np.array([1, 2, 3, 2, 3], np.int64)
    values = np.array([1.0, 2, 3, 4, 5])
    squares = np.array([1.0, 20, 34, 20, 34])
    lists = list(rowwise.block_lists(0, 1, [(rowwise.pack(size, cols, values, squares), 2, 5)], 1, True, chunk))
    i, j, sim = (np.concatenate(x) for x in zip(*lists))
    assert i.tolist() == [1, 2, 3] and j.tolist() == [3, 3, 2]
    assert sim[1] == pytest.approx(26 / (20 * 34) ** 0.5)


def test_large_tables_are_spread_over_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    df = spark.range(1000)
    assert session.spread(df, 1000, "id").rdd.getNumPartitions() == 100
    assert session.spread(df, 20, "id") is df


def test_positions_over_many_tasks(spark, monkeypatch):
    from sparkrec.operators import ordering
    monkeypatch.setattr(session, "ROWS_PER_TASK", 5)
    monkeypatch.setattr(ordering, "ROWS_PER_TASK", 5)
    from pyspark.sql import functions as F
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    rows = group_position(df, ["g"], [F.col("o").desc()]).collect()
    assert len(rows) == 500 and all(x["_pos"] == (x["_n"] - 1) - x["o"] // 3 for x in rows)


def test_terms_of_a_text_are_counted_where_the_text_is(spark):
    from sparkrec.operators import tfidf
    docs = spark.createDataFrame([(1, "red green red"), (1, "blue"), (2, "red"), (None, "green")], "movieId long, feature_text string")
    counts = tfidf.term_counts(docs)
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {(r.doc, r.term): r.tf for r in counts.collect()}
    assert got[1, "red"] == 2 and got[1, "blue"] == 1 and got[None, "green"] == 1
    weights, _ = tfidf.tfidf(docs, min_df=1)
    assert {r.movieId for r in weights.collect()} == {1, 2}  # as before: no rows without an id


def test_a_bucket_is_written_by_several_tasks(spark):
    from pyspark.sql import functions as F

    from sparkrec.operators import clean
    ratings = spark.range(400).selectExpr("id % 40 userId", "id movieId", "4.0D rating", "id timestamp")
    layout = clean.edge_layout(ratings, rows_per_bucket=100)
    rows = layout.edges(spark, "userId").withColumn("f", F.input_file_name())
    assert layout.buckets == 4 and rows.select("userId", "movieId").distinct().count() == 400
    assert rows.select("f").distinct().count() > layout.buckets


def test_whole_lists_are_neither_shuffled_nor_sorted_again(spark):
    from sparkrec.operators.similarity import item_similarity

    rows, e = sparse_entries(spark)
    sim = item_similarity(e.toDF("userId", "movieId", "rating"), 5)
    assert "WindowGroupLimit" not in sim._jdf.queryExecution().executedPlan().toString()
    got = sim.collect()
    assert {(x.movieId, x.neighborId) for x in got} == brute(rows, 5)
    by_movie = {}
    for x in got:
        by_movie.setdefault(x.movieId, []).append((x["rank"], -round(x.sim, 8), x.neighborId))
    for found in by_movie.values():
        assert [r for r, _, _ in sorted(found)] == list(range(1, len(found) + 1))
        assert sorted(found) == sorted(found, key=lambda f: f[1:])


def test_rounds_of_blocks_give_the_same_lists_and_send_each_block_once(spark, monkeypatch):
    rows, e = sparse_entries(spark)
    seen = []
    packer = rowwise._pack_task
    monkeypatch.setattr(rowwise, "_pack_task", lambda *a: seen.append(a) or packer(*a))
    monkeypatch.setattr(rowwise, "ROUND_PAIRS", 10_000)
    found = tiles.cosine_pairs(e, "r", "c", "v", top_k=5)
    assert {(x.i, x.j) for x in found.collect()} == brute(rows, 5) and found.columns == ["i", "j", "sim", "sim_r"]
    rounds = seen[0][2]
    assert rounds > 1 and [a[1] for a in seen] == list(range(rounds))
    placed = e.repartition(2, "r").sortWithinPartitions("r", "c").selectExpr("r", "c", "v", "1D AS q")
    blocks = [{r.blk for r in placed.mapInArrow(packer(64, part, 3), rowwise.PACK_SCHEMA).collect()} for part in range(3)]
    assert sum(map(len, blocks)) == len(set.union(*blocks)) == 64


def test_a_stage_leaves_no_shuffle_files(spark):
    from pyspark.sql import functions as F

    import os

    def held():
        roots = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for root in roots for _, _, names in os.walk(root) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = held()
    out = session.stage(spark.range(10_000).groupBy((F.col("id") % 100).alias("g")).agg(F.count(F.lit(1)).alias("n")))
    assert not held() - before and out.count() == 100
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_weights_of_slices_of_documents_are_those_of_all(spark, monkeypatch):
    from sparkrec.operators import tfidf

    words = "red green blue grey pink teal gold cyan".split()
    rows = [(d, " ".join(words[(d * k + k) % 8] for k in range(2, 9))) for d in range(30)] + [(3, "red teal red"), (None, "red gold"), (40, "")]
    docs = spark.createDataFrame(rows, "movieId long, feature_text string")

    def found():
        weights, vocab = tfidf.tfidf(docs, max_features=None)
        return ({(r.movieId, r.term, round(r.weight, 9)) for r in weights.collect()},
                {(r.term, r.df, r.total, round(r.idf, 9)) for r in vocab.collect()})

    whole = found()
    written = []
    monkeypatch.setattr(tfidf, "CHARS_PER_SLICE", 300)
    monkeypatch.setattr(tfidf, "staged_parts", lambda n, make: written.append(n) or session.staged_parts(n, make))
    assert found() == whole and len(whole[0]) > 200 and written[0] > 2
