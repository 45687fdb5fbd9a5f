"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each step is forced with the ``noop`` sink (full computation, nothing
collected).  ``prepare`` builds the shared tables once (dedup, activity
filter, time split, TF-IDF), as the reference's processed data; the other
steps reuse them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "simple_top10", "popular_recs", "item_similarity_top20", "cf_recs_sum", "cf_recs_weighted",
    "similar_items_genre", "tfidf_documents", "similar_items_tfidf", "content_recs", "blend_recs",
    "predict_batch", "eval_leave_last_out", "model_comparison",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from sparkrec.plans import common, registry
    from sparkrec.plans.q_content import movie_tfidf
    from sparkrec.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    registry.load_all()
    times: dict[str, float] = {}

    t0 = time.time()
    common.core_ratings(spark, sf_dir)
    common.time_split(spark, sf_dir)
    movie_tfidf(spark, sf_dir)
    times["prepare"] = round(time.time() - t0, 3)
    print(f"[bench] prepare: {times['prepare']}s", file=sys.stderr, flush=True)

    for name in names:
        t = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
        print(f"[bench] {name}: {times[name]}s", file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
