import math

from conftest import movies_df, ratings_df

from sparkrec.operators import blend, clean, content, profile, tfidf


def test_resolver(spark):
    m = movies_df(spark, [(1, "Matrix, The (1999)", "Action"), (2, "Matrix Reloaded (2003)", "Action"),
                          (3, "Matrix", "Action"), (12, "12 Angry Men (1957)", "Drama")])
    q = spark.createDataFrame([("1",), ("999999",), ("matrix",), ("Matrix",), ("nothing here",), ("12",)],
                              "query string")
    got = {r.query: (r.movieId, r.method) for r in content.resolve_titles(q, m).collect()}
    assert got["1"] == (1, "id")
    assert got["999999"] == (None, "unresolved")
    assert got["Matrix"] == (3, "exact")
    assert got["matrix"] == (1, "contains")   # titles with parentheses first, then the shorter one
    assert got["nothing here"] == (None, "unresolved")
    assert got["12"] == (12, "id")


def test_genre_similarity_excludes_self_and_shares(spark):
    m = movies_df(spark, [(1, "A", "Action|Sci-Fi"), (2, "B", "Action|Sci-Fi"), (3, "C", "Action|Drama"),
                          (4, "D", "(no genres listed)")])
    s = content.similar_by_genre(clean.clean_movies(m), k=10).collect()
    by_q = {}
    for r in s:
        by_q.setdefault(r.query_movieId, []).append(r)
    ranked = sorted(by_q[1], key=lambda r: r.rank)
    assert [r.movieId for r in ranked] == [2, 3]
    assert abs(ranked[0].similarity - 1.0) < 1e-12
    assert all(r.movieId != r.query_movieId for r in s)
    assert 4 not in by_q
    assert [r.movieId for r in content.items_without_genres(clean.clean_movies(m)).collect()] == [4]
    r13 = [r for r in s if r.query_movieId == 1 and r.movieId == 3][0]
    assert r13.shared_genres == "Action" and abs(r13.similarity - 0.5) < 1e-12


def test_tfidf_hand_computed(spark):
    docs = spark.createDataFrame([(1, "red apple"), (2, "red apple pie"), (3, "green pie")],
                                 "movieId long, feature_text string")
    w, v = tfidf.tfidf(docs, min_df=2)
    vocab = {r.term: (r.df, r.idf) for r in v.collect()}
    assert set(vocab) == {"red", "apple", "pie", "red apple"}
    idf2 = math.log(4 / 3) + 1
    assert all(abs(i - idf2) < 1e-12 for _, i in vocab.values())
    got = {(r.movieId, r.term): r.weight for r in w.collect()}
    assert abs(got[(1, "red")] - 1 / math.sqrt(3)) < 1e-12
    assert abs(got[(2, "pie")] - 0.5) < 1e-12
    assert abs(got[(3, "pie")] - 1.0) < 1e-12


def test_stop_words_removed_before_bigrams(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog"), (2, "cat dog")], "movieId long, feature_text string")
    terms = {r.term for r in tfidf.term_counts(docs).collect()}
    assert "cat dog" in terms and "the" not in terms and "and" not in terms


def test_profile_prefers_blend_item(spark):
    weights = spark.createDataFrame([(1, "x", 1.0), (2, "y", 1.0), (3, "x", 1 / math.sqrt(2)),
                                     (3, "y", 1 / math.sqrt(2)), (4, "z", 1.0)],
                                    "movieId long, term string, weight double")
    hist = ratings_df(spark, [(7, 1, 5.0), (7, 2, 5.0)])
    top = profile.ranked_content(hist, weights, 10).orderBy("rank").collect()
    assert [r.movieId for r in top] == [3]        # 4 shares nothing -> not positive


def test_normalize(spark):
    s = spark.createDataFrame([(1, 10, 2.0), (1, 11, 4.0), (2, 10, 0.0), (2, 12, 0.0)],
                              "userId long, movieId long, score double")
    got = {(r.userId, r.movieId): r.score for r in blend.normalize_scores(s).collect()}
    assert got == {(1, 10): 0.5, (1, 11): 1.0, (2, 10): 0.0, (2, 12): 0.0}
    empty = spark.createDataFrame([], "userId long, movieId long, score double")
    assert blend.normalize_scores(empty).count() == 0


def test_genre_backfill(spark):
    m = movies_df(spark, [(1, "A", "Action"), (2, "B", "(no genres listed)"), (3, "C", "Drama"), (4, "D", "Drama")])
    rows = content.similar_by_genre(clean.clean_movies(m), k=2, backfill=True).collect()
    got = {(r.query_movieId, r.rank): (r.movieId, round(r.similarity, 6)) for r in rows}
    assert got == {(1, 1): (2, 0.0), (1, 2): (3, 0.0), (3, 1): (4, 1.0), (3, 2): (1, 0.0), (4, 1): (3, 1.0), (4, 2): (1, 0.0)}
