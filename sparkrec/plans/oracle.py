"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement rebuilds the fixture views inline from the driver tables
(``lineitem orders part events documents``) and must return the same columns,
with the same names, as the matching Spark query.  Floating results are
rounded to 6 decimals on both sides.
"""

from __future__ import annotations

# --- fixture CTEs -----------------------------------------------------------

RATINGS_RAW = """
ratings_raw AS (
  SELECT o_custkey AS userId, l_partkey AS movieId,
         CAST(ceil(l_quantity / 5) / 2.0 AS DOUBLE) AS rating,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ts,
         l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RATINGS = RATINGS_RAW + """,
ratings AS (
  SELECT userId, movieId, rating, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY userId, movieId
                                 ORDER BY ts DESC, rating DESC, l_orderkey, l_linenumber) AS rn
    FROM ratings_raw) t
  WHERE rn = 1 AND rating >= 0.5 AND rating <= 5.0)"""

MOVIES = """
movies AS (
  SELECT p_partkey AS movieId,
    CASE WHEN p_partkey % 25 = 0 THEN p_name
         WHEN p_partkey % 25 = 1 THEN concat(p_name, ' (', CAST(1950 + p_partkey % 70 AS VARCHAR), ') (TV)')
         ELSE concat(p_name, ' (', CAST(1950 + p_partkey % 70 AS VARCHAR), ')') END AS title,
    CASE WHEN p_partkey % 50 = 0 THEN '(no genres listed)'
         WHEN p_partkey % 97 = 0 THEN NULL
         ELSE concat(p_type, '|', split_part(p_name, ' ', 1), '|', split_part(p_name, ' ', 2)) END AS genres
  FROM part)"""

EVENTS_RAW = """
ev_raw AS (
  SELECT user_id AS userId, CAST(json_extract_string(props, '$.k') AS BIGINT) AS movieId,
    CAST(CASE event_type WHEN 'purchase' THEN 5.0 WHEN 'signup' THEN 4.0 WHEN 'click' THEN 3.0
         WHEN 'view' THEN 2.0 ELSE 0.5 END AS DOUBLE) AS rating,
    CAST(floor(epoch(ts)) AS BIGINT) AS ts, event_id
  FROM events)"""


def activity_filter_sql(src: str, min_user: int, min_movie: int, passes: int, prefix: str = "af") -> str:
    """``passes`` unrolled movie-then-user filter passes over CTE ``src``.

    Applying a pass to a stable set changes nothing, so ``passes`` = the
    reference's pass cap gives exactly its result.  Returns CTE text whose last
    CTE is ``{prefix}{passes}``.
    """
    parts = [f"{prefix}0 AS (SELECT * FROM {src})"]
    for i in range(1, passes + 1):
        p = f"{prefix}{i - 1}"
        parts.append(
            f"{prefix}m{i} AS (SELECT * FROM {p} WHERE movieId IN "
            f"(SELECT movieId FROM {p} GROUP BY movieId HAVING count(*) >= {min_movie}))")
        parts.append(
            f"{prefix}{i} AS (SELECT * FROM {prefix}m{i} WHERE userId IN "
            f"(SELECT userId FROM {prefix}m{i} GROUP BY userId HAVING count(*) >= {min_user}))")
    return ",\n".join(parts)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


def core_sql(min_user: int = 20, min_movie: int = 20) -> str:
    """CTEs ending in ``core(userId, movieId, rating, ts)``: fixture A after A6."""
    return (RATINGS + ",\n" + activity_filter_sql("ratings", min_user, min_movie, 10) +
            ",\ncore AS (SELECT userId, movieId, rating, ts FROM af10)")


def sim_sql(src: str, name: str, k: int | None, row: str = "userId", col: str = "movieId",
            val: str = "rating") -> str:
    """Column cosine over CTE ``src`` -> ``name(movieId, neighborId, sim, rank)``."""
    lim = f"WHERE rank <= {k}" if k else ""
    return f"""
{name}_d AS (SELECT a.{col} AS i, b.{col} AS j, sum(a.{val} * b.{val}) AS dot
             FROM {src} a JOIN {src} b ON a.{row} = b.{row} AND a.{col} <> b.{col} GROUP BY 1, 2),
{name}_n AS (SELECT {col} AS movieId, sqrt(sum({val} * {val})) AS nn FROM {src} GROUP BY 1),
{name}_s AS (SELECT i, j, dot / (n1.nn * n2.nn) AS sim FROM {name}_d
             JOIN {name}_n n1 ON n1.movieId = i JOIN {name}_n n2 ON n2.movieId = j),
{name} AS (SELECT i AS movieId, j AS neighborId, sim, rank FROM (
             SELECT *, row_number() OVER (PARTITION BY i ORDER BY round(sim, 8) DESC, j) AS rank
             FROM {name}_s WHERE sim > 0) t {lim})"""


def time_split_sql(src: str, ratio: float = 0.2, min_test: int = 1) -> str:
    """Per-user time split of ``src`` -> CTEs ``train`` and ``test``."""
    return f"""
tsp AS (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts, movieId) - 1 AS pos,
               count(*) OVER (PARTITION BY userId) AS n FROM {src}),
tsf AS (SELECT *, greatest(least(greatest(floor(n * {ratio}), {min_test}), n - 1), 0) AS n_test FROM tsp),
train AS (SELECT userId, movieId, rating, ts FROM tsf WHERE NOT (pos >= n - n_test AND n_test > 0)),
test AS (SELECT userId, movieId, rating, ts FROM tsf WHERE pos >= n - n_test AND n_test > 0)"""


def liked_sql(src: str, name: str, fallback: bool, threshold: float = 4.0) -> str:
    base = f"SELECT userId, movieId, rating FROM {src} WHERE rating >= {threshold}"
    if not fallback:
        return f"\n{name} AS ({base})"
    return f"""
{name} AS ({base}
  UNION ALL
  SELECT userId, movieId, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY userId ORDER BY rating DESC, movieId) AS r FROM {src}
    WHERE userId NOT IN (SELECT userId FROM {src} WHERE rating >= {threshold})) t WHERE r <= 5)"""


def cf_scores_sql(hist: str, liked: str, sim: str, name: str, neighbors: int | None,
                  weighted: bool) -> str:
    """Unseen positive CF scores -> ``name(userId, movieId, score)``."""
    contrib = "s.sim * (l.rating / 5.0)" if weighted else "s.sim"
    nb = f"AND s.rank <= {neighbors}" if neighbors else ""
    return f"""
{name}_all AS (SELECT l.userId, s.neighborId AS movieId, sum({contrib}) AS score
               FROM {liked} l JOIN {sim} s ON s.movieId = l.movieId {nb} GROUP BY 1, 2),
{name} AS (SELECT * FROM {name}_all x WHERE score > 0 AND NOT EXISTS (
             SELECT 1 FROM {hist} h WHERE h.userId = x.userId AND h.movieId = x.movieId))"""


def top_k_sql(src: str, k: int, score: str = "score") -> str:
    return f"""SELECT userId, movieId, round({score}, 6) AS {score}, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY round({score}, 8) DESC, movieId) AS rank
  FROM {src}) t WHERE rank <= {k}"""


MOVIES_CLEAN = MOVIES + """,
mc AS (SELECT movieId, title, genres,
  array_to_string(list_filter(string_split(coalesce(genres, '(no genres listed)'), '|'),
                  lambda g: g <> '' AND g <> '(no genres listed)'), ' ') AS genres_text,
  list_filter(string_split(coalesce(genres, '(no genres listed)'), '|'),
              lambda g: g <> '' AND g <> '(no genres listed)') AS genres_list
  FROM movies)"""

STRIP = r"'^\s+|\s+$', '', 'g'"

FEATURES = MOVIES + rf""",
feat0 AS (SELECT movieId, regexp_replace(coalesce(title, ''), {STRIP}) AS title, genres FROM movies
          WHERE movieId IS NOT NULL),
feat1 AS (SELECT movieId, title, genres,
  regexp_replace(lower(regexp_replace(title, '\s*\(\d{{4}}\)\s*$', '')), {STRIP}) AS clean_title,
  regexp_replace(lower(replace(replace(coalesce(genres, ''), '(no genres listed)', ''), '|', ' ')), {STRIP})
    AS genres_text
  FROM feat0),
feat AS (SELECT * FROM (SELECT *, regexp_replace(regexp_replace(concat_ws(' ', clean_title, genres_text,
  genres_text), '\s+', ' ', 'g'), {STRIP}) AS feature_text FROM feat1) t WHERE length(feature_text) > 0)"""


def tfidf_sql(docs_sql: str, min_df: int = 2, max_features: int | None = 30000) -> str:
    """CTEs from ``docs(doc, feature_text)`` to ``weights(movieId, term, weight)``."""
    from sparkrec.functions import stopwords

    stop = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in stopwords.english()) + "]"
    return rf"""
docs AS ({docs_sql}),
tok AS (SELECT doc, list_filter(regexp_extract_all(lower(feature_text), '[\p{{L}}\p{{N}}_]{{2,}}'),
                                lambda t: NOT list_contains({stop}, t)) AS toks FROM docs),
terms AS (SELECT doc, unnest(CASE WHEN len(toks) >= 2 THEN list_concat(toks,
            list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) ELSE toks END) AS term
          FROM tok),
tf AS (SELECT doc, term, count(*) AS tf FROM terms GROUP BY 1, 2),
nd AS (SELECT count(*) AS n FROM docs),
vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 HAVING count(*) >= {min_df}
          ORDER BY total DESC, term {f'LIMIT {max_features}' if max_features else ''}),
idf AS (SELECT term, df, total, ln((1 + n) / (1 + df)) + 1 AS idf FROM vocab, nd),
tw AS (SELECT doc, term, tf * idf AS raw FROM tf JOIN idf USING (term)),
tn AS (SELECT doc, sqrt(sum(raw * raw)) AS nn FROM tw GROUP BY 1),
weights AS (SELECT doc AS movieId, term, raw / nn AS weight FROM tw JOIN tn USING (doc))"""
