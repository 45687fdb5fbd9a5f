"""Argument parsing and input resolution shared by the jobs."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from sparkrec.operators import clean
from sparkrec.session import get_spark
from sparkrec.sources import fixtures, io


def parser(description: str) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=description)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="driver tables directory (fixture A ratings/movies)")
    src.add_argument("--processed", help="directory written by the prepare job")
    p.add_argument("--out", required=True, help="output directory")
    return p


def session() -> SparkSession:
    return get_spark()


def inputs(spark: SparkSession, args) -> tuple[DataFrame, DataFrame]:
    """(movies, ratings) where ratings are deduplicated and range-checked."""
    if args.sf_dir:
        return (fixtures.movies_raw(spark, args.sf_dir),
                clean.prepare_ratings(fixtures.ratings_raw(spark, args.sf_dir)))
    movies, cf, _ = io.load_processed(spark, args.processed)
    return movies, io.load_ratings(cf)
