"""Column expressions for titles and genres.

All are built-in JVM expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkrec.schemas import NO_GENRES

# Fixed patterns (same meaning as the reference's regular expressions).
YEAR_AT_END = r"\((\d{4})\)[^()]*$"          # year = last "(yyyy)" with no later parentheses
TRAILING_YEAR = r"\s*\(\d{4}\)\s*$"           # "(yyyy)" at the very end, for clean titles
WS = r"\s+"


def strip_ws(c: Column) -> Column:
    """Strip leading/trailing whitespace of any kind (``trim`` only strips spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def year_from_title(title: Column) -> Column:
    """Nullable int year; ``nullif`` first because ANSI casts of '' fail."""
    return F.nullif(F.regexp_extract(title, YEAR_AT_END, 1), F.lit("")).cast("int")


def genres_list(genres: Column) -> Column:
    """Split on '|' and drop empty parts and the no-genre sentinel."""
    parts = F.split(F.coalesce(genres, F.lit(NO_GENRES)), r"\|")
    return F.filter(parts, lambda g: (g != F.lit("")) & (g != F.lit(NO_GENRES)))


def genres_text(genres_list_col: Column) -> Column:
    """The cleaned genre list joined by spaces."""
    return F.array_join(genres_list_col, " ")


def clean_title(title: Column) -> Column:
    """Strip, remove a trailing ``(yyyy)``, lower-case, strip."""
    t = strip_ws(F.coalesce(title, F.lit("")))
    return strip_ws(F.lower(F.regexp_replace(t, TRAILING_YEAR, "")))


def tfidf_genres_text(genres: Column) -> Column:
    """P5: null -> '', drop the sentinel literal, '|' -> ' ', lower, strip."""
    g = F.replace(F.coalesce(genres, F.lit("")), F.lit(NO_GENRES), F.lit(""))
    g = F.replace(g, F.lit("|"), F.lit(" "))
    return strip_ws(F.lower(g))


def feature_text(clean_title_col: Column, genres_text_col: Column) -> Column:
    """Title + genres twice (genre weight x2), whitespace collapsed."""
    t = F.concat_ws(" ", clean_title_col, genres_text_col, genres_text_col)
    return strip_ws(F.regexp_replace(t, WS, " "))


def shared_genres(a: Column, b: Column) -> Column:
    """Sorted intersection of two raw genre strings joined by '|' (sentinel kept)."""
    sa = F.split(F.coalesce(a, F.lit("")), r"\|")
    sb = F.split(F.coalesce(b, F.lit("")), r"\|")
    common = F.array_except(F.array_intersect(sa, sb), F.array(F.lit("")))
    return F.array_join(F.array_sort(common), "|")


def short_title(title: Column, width: int = 35) -> Column:
    """Title without its trailing year, cut to ``width`` characters."""
    return F.substring(F.regexp_replace(title, TRAILING_YEAR, ""), 1, width)
