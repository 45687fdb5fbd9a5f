"""Block-wise refresh of an item similarity table (S10, R4): only what changed ratings can reach is computed again.

Each item has an order-free digest of its ratings, kept with the model.  Items
whose digest differs from the new one's are changed; their cosines are computed
against the whole catalog, in tiles that hold a changed block.  Another item's
list is its old one without changed and removed neighbours, with the new
cosines merged in.  That is exact as long as the list reaches down to the old
last place, below which nothing unchanged can have moved up; items whose lists
do not are computed again like changed ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.operators.similarity import top_neighbours
from sparkrec.operators.tiles import RANK_DIGITS, cosine_pairs
from sparkrec.session import cut_lineage

DIGEST = ("n", "x", "s")


def item_digests(ratings: DataFrame) -> DataFrame:
    """``(movieId, n, x, s)``: count, XOR and sum of the hashes of each item's (user, rating) rows; combined map-side."""
    h = F.xxhash64(F.col("userId").cast("long"), F.col("rating").cast("double"))
    return ratings.groupBy(F.col("movieId").cast("long").alias("movieId")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s"))


def changed_items(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(movieId, present)``: items whose ratings differ, added (present) and removed (not present) ones included."""
    o = old.select("movieId", F.struct(*DIGEST).alias("old"))
    n = new.select("movieId", F.struct(*DIGEST).alias("new"))
    both = o.join(n, "movieId", "full_outer").filter(~F.col("old").eqNullSafe(F.col("new")))
    return both.select("movieId", F.col("new").isNotNull().alias("present"))


def _fresh(ratings: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(movieId, neighborId, sim, sim_r) with an end in ``items``: each item's ``k`` best of these and more."""
    return cosine_pairs(ratings, "userId", "movieId", "rating", top_k=k, only=items.select("movieId")).select(
        F.col("i").alias("movieId"), F.col("j").alias("neighborId"), "sim", "sim_r")


def refresh_similarity(old: DataFrame, digests: DataFrame, ratings: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(similarity, items that were computed again): ``item_similarity(ratings, k)`` from the table of other ratings.

    ``old`` is ``(movieId, neighborId, sim, rank)`` with lists of at most ``k`` (fewer than there are items)
    and ``digests`` the ``item_digests`` of its ratings.
    """
    touched = cut_lineage(changed_items(digests, item_digests(ratings)))
    changed = touched.filter("present").select("movieId")
    fresh = cut_lineage(_fresh(ratings, changed, k))
    scale = 10.0 ** RANK_DIGITS
    known = old.join(touched.select("movieId"), "movieId", "left_anti").withColumn("sim_r", F.rint(F.col("sim") * scale) / scale)
    gone = touched.select(F.col("movieId").alias("neighborId"), F.lit(True).alias("gone"))
    known = cut_lineage(known.join(gone, "neighborId", "left").withColumn("gone", F.col("gone").isNotNull()))
    kept = known.filter("NOT gone").select("movieId", "neighborId", "sim", "sim_r")
    own = fresh.join(touched.select("movieId"), "movieId", "left_anti")
    merged = kept.unionByName(own)
    # the old last place of each full list that lost a neighbour, and how many of the merged list reach it
    last = known.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("held"), F.count_if("gone").alias("lost"),
        F.min(F.struct("sim_r", (-F.col("neighborId")).alias("b"))).alias("last"))
    short = last.filter((F.col("held") >= k) & (F.col("lost") > 0))
    reached = merged.join(short, "movieId").groupBy("movieId").agg(
        F.count_if(F.struct("sim_r", (-F.col("neighborId")).alias("b")) >= F.col("last")).alias("reached"))
    again = cut_lineage(short.join(reached, "movieId", "left").filter(F.coalesce("reached", F.lit(0)) < k).select("movieId"))
    whole = fresh.join(changed, "movieId", "left_semi")
    if not again.isEmpty():
        whole = whole.unionByName(_fresh(ratings, again, k).join(again, "movieId", "left_semi"))
    rest = merged.join(again, "movieId", "left_anti")
    return top_neighbours(whole.unionByName(rest), k), changed.unionByName(again)
