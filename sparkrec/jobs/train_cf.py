"""K2: ratings -> time split -> item similarity (top-k) -> CF bundle with metadata."""

from __future__ import annotations

from functools import cache

from sparkrec.jobs._common import inputs, parser, session
from sparkrec.operators import similarity, split
from sparkrec.schemas import guard_ratings
from sparkrec.sources import io, model_store
from sparkrec.sources.stage_store import StageStore


def run(ratings, out: str, test_ratio=0.2, min_test=1, top_k=100, threshold=4.0) -> list[str]:
    """Train and commit the model; returns the stages that this call had to make."""
    guard_ratings(ratings)
    store = StageStore(ratings.sparkSession, f"{out}/stages")
    rated = store.source("ratings", ratings)
    parts = cache(lambda: split.time_split(rated.frame, test_ratio, min_test))
    train = store.stage("train", lambda: parts()[0], [test_ratio, min_test], [rated])
    test = store.stage("test", lambda: parts()[1], [test_ratio, min_test], [rated])
    io.write_parquet(train.frame, f"{out}/rating_cf_train.parquet")
    io.write_parquet(test.frame, f"{out}/rating_cf_test.parquet")
    sim = store.stage("similarity", lambda: similarity.item_similarity(train.frame, top_k), [top_k], [train])
    metadata = model_store.knn_cf_metadata(train.frame, test.frame, sim.frame, test_ratio, threshold)
    model_store.save_cf_model(train.frame, sim.frame, f"{out}/knn_cf", more={"metadata": metadata})
    return store.made


def main(argv=None) -> None:
    p = parser(__doc__)
    p.add_argument("--test-ratio", type=float, default=0.2)
    p.add_argument("--top-k", type=int, default=100)
    a = p.parse_args(argv)
    spark = session()
    _, ratings = inputs(spark, a)
    run(ratings, a.out, a.test_ratio, 1, a.top_k)


if __name__ == "__main__":
    main()
