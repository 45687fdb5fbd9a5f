"""URL filter (4): a blocked Bloom filter in front of an exact hash join, in DataFrame functions only.

Listed entries are canonical ``host + path prefix`` strings.  A url's candidates
are its host suffixes joined with the path prefixes of the lengths that occur in
the list; the filter (``ENTRY_BITS`` bits an entry, one 256-bit block per key)
passes those that may be listed, and only they are exploded and joined exactly
with the list, which removes the false positives; urls without one go by.  The filter grows
with the list up to ``MAX_WORDS``; beyond, it passes more to the join.  The longest listed candidate
decides; a url without one gets the default verdict.

Defined cases: a null url, or one without ``://``, has empty host and path and
fits no entry with a host; an empty list gives every url the default; repeated
list entries count once (``block`` wins over ``allow``); entries with null parts
take no part; repeated pages stay repeated; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WORDS = 1 << 20  # 64-bit words of the filter at most (8 MiB are sent to each task)
ENTRY_BITS = 16
BLOCK_WORDS = 4
PROBES = 4


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def labels(host: Column) -> Column:
    return F.size(F.split(host, F.lit(r"\.")))


def words_for(entries: int) -> int:
    """Words of a filter of so many entries: a power of two, so that lists of like size share a plan."""
    return min(MAX_WORDS, max(1 << 10, 1 << (entries * ENTRY_BITS // 64).bit_length()))


def _bits(key: Column, n_words: int) -> list[tuple[Column, Column]]:
    """(word, mask) of each probe: the key's block, then bits within it from a second hash."""
    block = F.pmod(F.xxhash64(key), F.lit(n_words // BLOCK_WORDS))
    second = F.xxhash64(key, F.lit("b"))
    out = []
    for i in range(PROBES):
        bit = F.shiftrightunsigned(second, 8 * i).bitwiseAND(F.lit(255))
        word = block * BLOCK_WORDS + F.shiftright(bit, 6)
        out.append((word.cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))))
    return out


def build_filter(keys: DataFrame, n_words: int) -> DataFrame:
    """One row ``words``: the filter over column ``key`` as an array of ``n_words`` longs."""
    probes = F.array(*[F.struct(w.alias("word"), m.alias("mask")) for w, m in _bits(F.col("key"), n_words)])
    spark = keys.sparkSession
    words = (keys.select(F.explode(probes).alias("p")).select("p.*")
             .groupBy("word").agg(F.bit_or("mask").alias("mask")))
    full = spark.range(n_words).select(F.col("id").cast("int").alias("word")).join(words, "word", "left")
    return full.agg(F.transform(F.sort_array(F.collect_list(
        F.struct("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")))), lambda s: s["mask"]).alias("words"))


def might_contain(words: Column, key: Column, n_words: int) -> Column:
    out = F.lit(True)
    for word, mask in _bits(key, n_words):
        out = out & (F.get(words, word).bitwiseAND(mask) == mask)
    return out


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (page_id, url) with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` holds ``host``, ``path`` and ``verdict`` (allow or block).
    """
    listed = (rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
              .dropna()
              .groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
              .withColumn("key", F.concat_ws("", "r_host", "r_path")))
    shape = F.struct(labels(F.col("r_host")).alias("labels"), F.length("r_path").alias("chars"))
    spec = listed.agg(F.array_distinct(F.collect_set(shape)).alias("shapes"))
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    n_words = words_for(listed.count())
    urls = (urls.withColumn("row", F.monotonically_increasing_id())
            .withColumn("words", build_filter(listed.select("key"), n_words).scalar())
            .withColumn("shapes", spec.scalar()))
    fitting = F.filter("shapes", lambda s: (s["labels"] <= labels(F.col("host"))) & (s["chars"] <= F.length("path")))
    candidates = F.transform(fitting, lambda s: F.struct(
        F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"]).alias("h"),
        F.substring(F.col("path"), F.lit(1), s["chars"]).alias("p")))
    hits = F.filter(candidates, lambda c: might_contain(F.col("words"), F.concat(c["h"], c["p"]), n_words))
    urls = urls.select("row", "page_id", "host", "path", hits.alias("hits"))
    clear = urls.filter(F.size("hits") == 0).select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                                                    F.lit(default).alias("verdict"))
    probed = urls.filter(F.size("hits") > 0).select("row", "page_id", "host", "path", F.explode("hits").alias("c"))
    probed = probed.select("row", "page_id", "host", "path", F.col("c.h").alias("r_host"), F.col("c.p").alias("r_path"))
    exact = probed.join(listed.drop("key"), ["r_host", "r_path"], "left")
    found = F.when(F.col("r_verdict").isNotNull(), F.struct(
        (F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"),
        F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")))
    best = exact.groupBy("row", "page_id", "host", "path").agg(F.max(found).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict")).unionByName(clear)
