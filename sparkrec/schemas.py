"""Declared schemas and input guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values shared with the reference data dictionary.
NO_GENRES = "(no genres listed)"

MOVIES_RAW = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

RATINGS_RAW = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("timestamp", T.LongType()),
])

RATINGS = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])


def require_columns(df: DataFrame, columns, what: str = "input") -> None:
    """Raise ``ValueError`` naming every missing column (schema-only check)."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")


def guard_ratings(df: DataFrame, cols=("userId", "movieId", "rating")) -> None:
    """One aggregate that rejects empty input and null/NaN ids or ratings."""
    checks = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        bad = F.col(c).isNull()
        if dict(df.dtypes)[c] in ("float", "double"):
            bad = bad | F.isnan(F.col(c))
        checks.append(F.count_if(bad).alias(c))
    row = df.select(*cols).agg(*checks).first()
    if row["n"] == 0:
        raise ValueError("ratings DataFrame is empty")
    bad_cols = [c for c in cols if row[c]]
    if bad_cols:
        raise ValueError(f"ratings contain null/NaN values in {bad_cols}; clean the data first")
