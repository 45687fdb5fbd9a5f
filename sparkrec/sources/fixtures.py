"""Rating and movie tables derived from the driver's parquet tables.

The driver data carries no ratings, so they are derived by fixed rules
(FIXTURES.md).  Every derived table is a lazy plan over the whole source
tables: nothing is sampled or capped.

Fixture A: user = customer, movie = part, rating = quantity in half steps.
Fixture B: ratings from the ``events`` table (event type -> rating).
Fixture C: ``documents`` as (movieId, feature_text) for TF-IDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.schemas import NO_GENRES
from sparkrec.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a ``timestamp_ntz`` column, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A raw ratings: one row per line item (duplicate pairs included)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = spread(li, li.count(), "l_orderkey")  # the count is read from the files' footers
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .select(
            F.col("o_custkey").alias("userId"),
            F.col("l_partkey").alias("movieId"),
            (F.ceil(F.col("l_quantity") / 5) / F.lit(2.0)).cast("double").alias("rating"),
            epoch_seconds(F.col("o_orderdate")).alias("timestamp"),
            "l_orderkey",
            "l_linenumber",
        )
    )


def movies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A movies: titles with a year (some with a trailing ``(TV)``), pipe genres."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    k = F.col("p_partkey")
    year = (F.lit(1950) + k % 70).cast("string")
    title = (
        F.when(k % 25 == 0, F.col("p_name"))
        .when(k % 25 == 1, F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(") (TV)")))
        .otherwise(F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(")")))
    )
    words = F.split(F.col("p_name"), " ")
    genres = (
        F.when(k % 50 == 0, F.lit(NO_GENRES))
        .when(k % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat_ws("|", F.col("p_type"), F.coalesce(words[0], F.lit("")),
                               F.coalesce(words[1], F.lit(""))))
    )
    return p.select(k.alias("movieId"), title.alias("title"), genres.alias("genres"))


# Event type -> rating for fixture B.
EVENT_RATING = {"purchase": 5.0, "signup": 4.0, "click": 3.0, "view": 2.0}
EVENT_RATING_OTHER = 0.5


def ratings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture B raw ratings from the events stream table."""
    ev = table(spark, sf_dir, "events")
    rating = F.lit(EVENT_RATING_OTHER)
    for name, value in reversed(list(EVENT_RATING.items())):
        rating = F.when(F.col("event_type") == name, F.lit(value)).otherwise(rating)
    return ev.select(
        F.col("user_id").alias("userId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("movieId"),
        rating.cast("double").alias("rating"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        "event_id",
    )


def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture C: documents as (movieId, feature_text), whole texts."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("movieId"), F.col("text").alias("feature_text"))
