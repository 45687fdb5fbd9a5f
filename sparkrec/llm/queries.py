"""Registered queries of the training-data operators (thin: each gets its rows from its operator)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.llm import align, chat, decontam, html_text, langid, neardup, ngram_join, packing, repair, tokenfiles, topk, toxicity, urls
from sparkrec.llm.common import scratch_path, staged, table
from sparkrec.session import ship_package

#: Score from which a document counts as toxic.
TOXIC_FROM = 0.3

QUERIES = {}
ORACLE = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda ids: ids % 50 == 0, k=5)


ORACLE["op1_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.digest(packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, added_tokens=True))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenfiles.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=2,
                                 added_tokens=True)
    rows = staged(tokenfiles.read_token_files(spark, path), "token-rows")
    return tokenfiles.with_global_start(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def held_out() -> Column:
    """The evaluation fold by document id; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = langid.train(docs.filter(F.col("doc_id").isNotNull() & ~F.col("held_out")))
    return langid.predict(docs, model, ["doc_id", "held_out"]).select("row.*", "lang_pred", "score")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = toxicity.predict(docs, grammar, ["doc_id", "held_out"]).select("row.*", "score")
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


#: The filter's rules: verdict, host, path (fixed by the query's contract).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


ORACLE["op4_url_filter"] = """
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id, regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's') AS h,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
v AS (SELECT rid, page_id, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM u),
r(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (
  SELECT v.rid, r.verdict, r.rh || r.rp AS rule,
         row_number() OVER (PARTITION BY v.rid ORDER BY length(r.rh || r.rp) DESC, length(r.rh) DESC) AS k
  FROM v JOIN r ON (v.host = r.rh OR ends_with(v.host, '.' || r.rh)) AND starts_with(v.path, r.rp))
SELECT v.page_id, v.host, v.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM v LEFT JOIN m ON v.rid = m.rid AND m.k = 1
"""


#: A conversation that holds the template's own control strings.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], turns.schema)
    return chat.digest(chat.format_chat(turns.unionByName(extra)))


ORACLE["op8_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(text) + length(role) + 14
        + len(regexp_extract_all(text || role, '[\\#<:]')) AS chars FROM t),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
         CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
         CAST(sum(chars) AS BIGINT) AS formatted_chars,
         arg_max(role, (coalesce(turn, -9223372036854775808), turn IS NOT NULL, role, text)) AS last_role,
         string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
                    ORDER BY turn NULLS FIRST, role, text) AS roles
  FROM e GROUP BY conv_id),
m AS (SELECT * EXCLUDE (last_role, roles),
             CASE WHEN regexp_full_match(roles, 's|s?(ua)*u|s?(ua)+') THEN last_role ELSE 'reject' END AS state FROM c)
SELECT *, state = 'assistant' AS valid FROM m
"""


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    found = align.digest(table(spark, sf_dir, "documents"), *paths, keep=["doc_id"])
    return found.select("row.doc_id", *found.columns[1:])


@query
def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.read_rows(table(spark, sf_dir, "conversations"))
    return repair.digest(rows, repair.repair(repair.damage(rows)))


ORACLE["op11_structure_repair"] = r"""
WITH RECURSIVE
polynomial AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
hashed AS (
  SELECT given.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''), lambda x: CAST(ord(x) AS BIGINT))),
                                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d
  FROM given, polynomial),
damaged AS (
  SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed WHERE d <> 0
  UNION ALL SELECT conv_id, turn, role, text FROM hashed WHERE d = 3),
numbered AS (
  SELECT *, row_number() OVER w AS i, left(lag(role) OVER w, 1) || left(role, 1) AS pair
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
faults AS (
  SELECT *, left(role, 1) AS r, CASE
      WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM numbered),
priced AS (SELECT *, fault IN ('', 'truncated') AS may, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra,
                  chr(10) || role || ':' || text AS kept FROM faults),
counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM priced GROUP BY conv_id),
costs AS (
  SELECT conv_id, n AS i, {'c': 0, 'a': '', 't': ''} AS s0, {'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s1,
         {'c': 3, 'a': 'I', 't': chr(10) || 'assistant:'} AS s2, {'c': 0, 'a': '', 't': ''} AS s3
  FROM counts
  UNION ALL
  SELECT conv_id, i - 1, list_sort([b0, {'c': u.c + 3, 'a': 'I' || u.a, 't': chr(10) || 'user:' || u.t}])[1],
         list_sort([b1, {'c': u.c + 3, 'a': 'I' || u.a, 't': chr(10) || 'user:' || u.t}])[1], u,
         list_sort([b3, {'c': b2.c + 3, 'a': 'I' || b2.a, 't': chr(10) || 'user:' || b2.t}])[1]
  FROM (
    SELECT *, list_sort([b2, {'c': b3.c + 3, 'a': 'I' || b3.a, 't': chr(10) || 'assistant:' || b3.t}])[1] AS u
    FROM (
      SELECT c.conv_id, c.i,
        list_sort([{'c': s0.c + 4, 'a': 'D' || s0.a, 't': s0.t},
          CASE WHEN may AND r = 's' THEN {'c': s1.c + extra, 'a': 'K' || s1.a, 't': kept || s1.t} END,
          CASE WHEN may AND r = 'u' THEN {'c': s2.c + extra, 'a': 'K' || s2.a, 't': kept || s2.t} END,
          CASE WHEN may THEN {'c': s2.c + 3 + extra, 'a': 'R' || s2.a, 't': chr(10) || 'user:' || text || s2.t} END], 'ASC', 'NULLS LAST')[1] AS b0,
        list_sort([{'c': s1.c + 4, 'a': 'D' || s1.a, 't': s1.t},
          CASE WHEN may AND r = 'u' THEN {'c': s2.c + extra, 'a': 'K' || s2.a, 't': kept || s2.t} END,
          CASE WHEN may THEN {'c': s2.c + 3 + extra, 'a': 'R' || s2.a, 't': chr(10) || 'user:' || text || s2.t} END], 'ASC', 'NULLS LAST')[1] AS b1,
        list_sort([{'c': s2.c + 4, 'a': 'D' || s2.a, 't': s2.t},
          CASE WHEN may AND r = 'a' THEN {'c': s3.c + extra, 'a': 'K' || s3.a, 't': kept || s3.t} END,
          CASE WHEN may THEN {'c': s3.c + 3 + extra, 'a': 'R' || s3.a, 't': chr(10) || 'assistant:' || text || s3.t} END], 'ASC', 'NULLS LAST')[1] AS b2,
        list_sort([{'c': s3.c + 4, 'a': 'D' || s3.a, 't': s3.t},
          CASE WHEN may AND r = 'u' THEN {'c': s2.c + extra, 'a': 'K' || s2.a, 't': kept || s2.t} END,
          CASE WHEN may THEN {'c': s2.c + 3 + extra, 'a': 'R' || s2.a, 't': chr(10) || 'user:' || text || s2.t} END], 'ASC', 'NULLS LAST')[1] AS b3
      FROM costs c JOIN priced p ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.i = p.i)))
SELECT o.conv_id, CAST(coalesce(n.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(n.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(n.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(n.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(n.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(c.s0.c, 0) AS BIGINT) AS cost,
       coalesce(c.s0.a, '') AS audit, sha256(substr(coalesce(c.s0.t, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts n ON o.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN costs c ON o.conv_id IS NOT DISTINCT FROM c.conv_id AND c.i = 0
"""


@query
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


ORACLE["op12_ngram_join"] = r"""
WITH RECURSIVE
rows_ AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w FROM documents),
sets AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM rows_),
items AS (SELECT rid, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM items a JOIN items b ON a.x = b.x AND a.rid <> b.rid AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT rid AS a, rid AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT x.doc_id, CAST(len(x.s) AS BIGINT) AS n_shingles, min(y.doc_id) AS component_id
FROM reach r JOIN sets x ON r.a = x.rid JOIN sets y ON r.b = y.rid GROUP BY x.rid, x.doc_id, x.s
"""
