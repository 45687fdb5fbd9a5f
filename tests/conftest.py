import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[2]").appName("sparkrec-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from sparkrec.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s


def ratings_df(spark, rows, with_ts=True):
    """rows: (userId, movieId, rating[, timestamp])"""
    if with_ts:
        rows = [r if len(r) == 4 else (*r, 0) for r in rows]
        return spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long")
    return spark.createDataFrame(rows, "userId long, movieId long, rating double")


def movies_df(spark, rows):
    return spark.createDataFrame(rows, "movieId long, title string, genres string")
