"""K4: build the CF and content bundles in one session."""

from __future__ import annotations

from sparkrec.jobs import train_cf, train_content
from sparkrec.jobs._common import inputs, parser, session


def main(argv=None) -> None:
    a = parser(__doc__).parse_args(argv)
    spark = session()
    movies, ratings = inputs(spark, a)
    train_cf.run(ratings, a.out)
    train_content.run(movies, a.out)


if __name__ == "__main__":
    main()
