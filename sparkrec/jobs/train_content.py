"""K3: movies -> feature text -> TF-IDF -> content bundle with metadata."""

from __future__ import annotations

from functools import cache

from sparkrec.jobs._common import inputs, parser, session
from sparkrec.operators import tfidf
from sparkrec.sources import model_store
from sparkrec.sources.stage_store import StageStore


def run(movies, out: str, min_df=2, max_features=30000, k=50) -> list[str]:
    """Train and commit the bundle; returns the stages that this call had to make."""
    store = StageStore(movies.sparkSession, f"{out}/stages")
    catalog = store.source("movies", movies)
    feats = store.stage("features", lambda: tfidf.prepare_features(catalog.frame), [], [catalog])
    parts = cache(lambda: tfidf.tfidf(feats.frame, min_df=min_df, max_features=max_features))
    weights = store.stage("weights", lambda: parts()[0], [min_df, max_features], [feats])
    vocab = store.stage("vocabulary", lambda: parts()[1], [min_df, max_features], [feats])
    similar = store.stage("similar_items", lambda: tfidf.similar_by_tfidf(weights.frame, k), [k], [weights])
    model_store.save_bundle({
        "movies_content": feats.frame, "item_features": weights.frame, "vocabulary": vocab.frame, "similar_items": similar.frame,
        "metadata": model_store.content_metadata(feats.frame, weights.frame, vocab.frame, min_df, max_features),
    }, f"{out}/knn_content")
    return store.made


def main(argv=None) -> None:
    p = parser(__doc__)
    p.add_argument("--min-df", type=int, default=2)
    p.add_argument("--max-features", type=int, default=30000)
    a = p.parse_args(argv)
    spark = session()
    movies, _ = inputs(spark, a)
    run(movies, a.out, a.min_df, a.max_features)


if __name__ == "__main__":
    main()
