"""K5/K6/K7: evaluate popular, CF, content and the hybrid alpha sweep; write summaries.

Writes per-model per-user Parquet, the alpha comparison, the best alpha and the
model comparison as CSV + JSON.  Every shared part (split, users, similarity,
TF-IDF weights, each model's per-user rows) is a stage that is made once; the
sinks read the stages, and a restarted job goes on behind the last finished one.
"""

from __future__ import annotations

from functools import cache

from sparkrec.jobs._common import inputs, parser, session
from sparkrec.operators import evaluate, metrics, similarity, split, tfidf
from sparkrec.sources import io
from sparkrec.sources.stage_store import StageStore

THRESHOLD = 4.0


def run(movies, ratings, out: str, users_n=100, seed=42, k=10, cf_neighbors=30, hybrid_neighbors=50,
        alphas=(0.5, 0.6, 0.7, 0.8, 0.9), models=("popular", "cf", "content", "hybrid")) -> list[str]:
    """Evaluate ``models``; returns the stages that this call had to make."""
    store = StageStore(ratings.sparkSession, f"{out}/stages")
    rated, catalog = store.source("ratings", ratings), store.source("movies", movies)
    parts = cache(lambda: split.time_split(rated.frame, 0.2, 1))
    train = store.stage("train", lambda: parts()[0], [0.2, 1], [rated])
    test = store.stage("test", lambda: parts()[1], [0.2, 1], [rated])
    users = store.stage("users", lambda: evaluate.select_users(train.frame, test.frame, users_n, seed), [users_n, seed], [train, test])
    base = (train.frame, test.frame, users.frame)
    needs = [train, test, users]
    summaries = []
    if {"cf", "hybrid"} & set(models):
        sim = store.stage("similarity", lambda: similarity.item_similarity(train.frame, 100), [100], [train])
    if {"content", "hybrid"} & set(models):
        weights = store.stage("weights", lambda: tfidf.tfidf(tfidf.prepare_features(catalog.frame))[0], [], [catalog])

    def per_user(name, make, params, after):
        rows = store.stage(f"{name}_user_metrics", make, params, needs + after).frame
        io.write_parquet(rows, f"{out}/{name}_user_metrics")
        return rows

    if "popular" in models:
        rows = per_user("popular", lambda: evaluate.evaluate_popular(*base, k)[0], [k], [])
        summaries.append(metrics.summarize(rows, "popular", k, THRESHOLD))
    if "cf" in models:
        rows = per_user("cf", lambda: evaluate.evaluate_cf(*base, sim.frame, k, cf_neighbors)[0], [k, cf_neighbors], [sim])
        summaries.append(metrics.summarize(rows, "knn_cf", k, THRESHOLD))
    if "content" in models:
        rows = per_user("content", lambda: evaluate.evaluate_content(*base, weights.frame, k)[0], [k], [weights])
        summaries.append(metrics.summarize(rows, "knn_content", k, THRESHOLD))
    if "hybrid" in models:
        rows = per_user("hybrid", lambda: evaluate.alpha_sweep(*base, sim.frame, weights.frame, alphas, k, hybrid_neighbors)[0],
                        [k, hybrid_neighbors, list(alphas)], [sim, weights])
        sweep = store.stage("alpha_summary", lambda: evaluate.alpha_summary(rows, k, THRESHOLD), [k, hybrid_neighbors, list(alphas)],
                            needs + [sim, weights]).frame
        io.write_csv(sweep, f"{out}/hybrid_alpha_comparison")
        best = evaluate.best_alpha(sweep, k)
        io.write_json(best, f"{out}/hybrid_best_alpha")
        summaries.append(best)
    compared = store.stage("comparison", lambda: evaluate.compare_models(summaries),
                           [k, users_n, seed, cf_neighbors, hybrid_neighbors, list(alphas), list(models)], needs + [catalog]).frame
    io.write_csv(compared, f"{out}/model_comparison")
    io.write_json(compared, f"{out}/model_comparison_json")
    return store.made


def main(argv=None) -> None:
    p = parser(__doc__)
    p.add_argument("--users", type=int, default=100)
    p.add_argument("--models", default="popular,cf,content,hybrid")
    a = p.parse_args(argv)
    spark = session()
    movies, ratings = inputs(spark, a)
    print("made", *run(movies, ratings, a.out, a.users, models=tuple(a.models.split(","))))


if __name__ == "__main__":
    main()
