"""K8: leave-last-out HR@10 / NDCG@10 for item CF (sample 0 = every eligible user)."""

from __future__ import annotations

from sparkrec.jobs._common import inputs, parser, session
from sparkrec.operators import evaluate
from sparkrec.sources import io


def main(argv=None) -> None:
    p = parser(__doc__)
    p.add_argument("--sample", type=int, default=200)
    p.add_argument("--k", type=int, default=10)
    p.add_argument("--min-rating", type=float, default=4.0)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--sizes", type=int, nargs="*", default=(), help="sample sizes to evaluate and time one by one (E19)")
    a = p.parse_args(argv)
    spark = session()
    _, ratings = inputs(spark, a)
    s = evaluate.leave_last_out_eval(ratings, a.sample or None, a.k, a.min_rating, a.seed)
    io.write_csv(s, f"{a.out}/cf_eval_scores")
    if a.sizes:
        io.write_csv(evaluate.timed_sweep(ratings, a.sizes, a.k, a.min_rating, a.seed), f"{a.out}/cf_eval_sizes")


if __name__ == "__main__":
    main()
