"""Exact sparse co-occurrence ``A^T A`` as tiles, without emitting raw pairs.

Input: long-form entries ``(row, col, value)``, e.g. (userId, movieId, rating)
or (token, movieId, weight).  Output: ``(a, b, dot)`` for every unordered
column pair that shares at least one row, ``dot = sum_r v[r,a] * v[r,b]``.

Work split:

* columns are hashed into ``nb`` blocks, rows into ``P`` row-groups;
* a tile is ``(row-group p, column block lo, column block hi)`` with lo <= hi;
  every entry goes to the ``nb`` tiles of its block (``explode`` of a short
  sequence, not a join), so each tile holds only the entries of its rows in
  two blocks;
* inside a tile, NumPy accumulates the block product with ``bincount``
  (a sparse-times-sparse product), and only the non-zero *sums* leave the
  task -- pairs are pre-aggregated before any shuffle;
* with several row-groups, a tile sends its share of the block product packed
  by sub-blocks of columns; one reducer per (lo, hi, sub-block) adds the ``P``
  shares and their squared norms, scores and keeps each column's best, so pair
  rows are never shuffled, only top-k lists.

A row with many entries (a heavy user) is cut by the column blocks; a column
with many entries (a popular movie or token) is cut by the row-groups, so no
tile grows with the hottest key.  ``nb`` and ``P`` follow from two counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.operators import rowwise

MAX_COL_BLOCK = 4096      # columns per block at most (dense block is MAX^2 doubles)
MAX_BLOCKS = 64           # column blocks at most (each entry is copied to this many tiles)
TILE_ENTRIES = 1_000_000  # target entries per tile
PAIR_CHUNK = 4_000_000    # products materialised at once inside a tile
RANK_DIGITS = 8           # rankings compare scores rounded to 8 decimals (float-order noise)

PART_FIELDS = ("lo", "hi", "sub", "ca", "qa", "cb", "qb", "i", "j", "d")
PART_SCHEMA = ("lo long, hi long, sub long, ca array<long>, qa array<double>, cb array<long>, qb array<double>, "
               "i array<long>, j array<long>, d array<double>")
SIM_SCHEMA = "i long, j long, sim double, sim_r double"


MAX_ACC_CELLS = 16_000_000  # dense (na x nb) accumulator at most; larger blocks accumulate sparsely


def _block_product(pdf: pd.DataFrame, max_cells: int = MAX_ACC_CELLS):
    """Tile -> (lo, hi, cols_a, cols_b, acc, norm_a, norm_b).

    ``acc`` is a dense ``(na, nb)`` array, or a sparse triple ``(i, j, dot)``
    when the dense block would exceed ``MAX_ACC_CELLS`` (very large catalogs).
    """
    lo, hi = int(pdf["lo"].iat[0]), int(pdf["hi"].iat[0])
    blk = pdf["blk"].to_numpy()
    r = pdf["r"].to_numpy()
    c = pdf["c"].to_numpy()
    v = pdf["v"].to_numpy(dtype=np.float64)
    ma = blk == lo
    mb = blk == hi
    ra, va = r[ma], v[ma]
    rb, vb = r[mb], v[mb]
    cols_a, ca = np.unique(c[ma], return_inverse=True)
    cols_b, cb = np.unique(c[mb], return_inverse=True)
    if len(cols_a) * len(cols_b) > max_cells:
        acc = _accumulate_sparse(ra, ca, va, rb, cb, vb, len(cols_b))
    else:
        acc = _accumulate(ra, ca, va, rb, cb, vb, len(cols_a), len(cols_b))
    norm_a = np.sqrt(np.bincount(ca, weights=va * va, minlength=len(cols_a)))
    norm_b = np.sqrt(np.bincount(cb, weights=vb * vb, minlength=len(cols_b)))
    return lo, hi, cols_a, cols_b, acc, norm_a, norm_b


def _pair_chunks(ka, ca, va, kb, cb, vb):
    """Yield (a_idx, b_idx, products) for co-occurring entries, in chunks of <= PAIR_CHUNK."""
    keys = np.unique(np.concatenate([ka, kb]))
    ia = np.searchsorted(keys, ka)
    ib = np.searchsorted(keys, kb)
    cnt_b = np.bincount(ib, minlength=len(keys))
    order_a = np.argsort(ia, kind="stable")
    order_b = np.argsort(ib, kind="stable")
    start_b = np.cumsum(cnt_b) - cnt_b
    reps_all = cnt_b[ia[order_a]]
    cum = np.cumsum(reps_all)
    begin = 0
    while begin < len(order_a):
        base = cum[begin - 1] if begin else 0
        end = max(int(np.searchsorted(cum, base + PAIR_CHUNK, side="right")), begin + 1)
        sel = order_a[begin:end]
        reps = reps_all[begin:end]
        total = int(reps.sum())
        if total:
            a_idx = np.repeat(sel, reps)
            within = np.arange(total) - np.repeat(np.cumsum(reps) - reps, reps)
            b_idx = order_b[np.repeat(start_b[ia[sel]], reps) + within]
            yield ca[a_idx], cb[b_idx], va[a_idx] * vb[b_idx]
        begin = end


def _accumulate_sparse(ka, ca, va, kb, cb, vb, nb: int):
    """Sparse ``(i, j, dot)`` of co-occurring column pairs; memory ~ distinct pairs."""
    codes, sums = [], []
    for ai, bi, prod in _pair_chunks(ka, ca, va, kb, cb, vb):
        u, inv = np.unique(ai.astype(np.int64) * nb + bi, return_inverse=True)
        codes.append(u)
        sums.append(np.bincount(inv, weights=prod))
    if not codes:
        e = np.zeros(0, dtype=np.int64)
        return e, e, np.zeros(0)
    u, inv = np.unique(np.concatenate(codes), return_inverse=True)
    tot = np.bincount(inv, weights=np.concatenate(sums))
    return u // nb, u % nb, tot


def _topk_sparse(rows, cols, vals, k: int) -> np.ndarray:
    """Mask of the ``k`` best entries per row under (value at 8 dp desc, col asc)."""
    if len(rows) == 0:
        return np.zeros(0, dtype=bool)
    order = np.lexsort((cols, -np.round(vals, RANK_DIGITS), rows))
    r_sorted = rows[order]
    first = np.r_[True, r_sorted[1:] != r_sorted[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    keep = np.zeros(len(rows), dtype=bool)
    keep[order[(np.arange(len(order)) - start) < k]] = True
    return keep


def _tile_parts(n_sub: int, max_cells: int = MAX_ACC_CELLS):
    """Tile kernel for split row-groups: this row-group's share of the block product, packed by sub-blocks of ``lo`` columns."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi, cols_a, cols_b, acc, norm_a, norm_b = _block_product(pdf, max_cells)
        if isinstance(acc, tuple):
            i, j, d = acc
        else:
            i, j = np.nonzero(acc)
            d = acc[i, j]
        sub = _sub_block(cols_a, n_sub)
        out = {name: [] for name in PART_FIELDS}
        for s in range(n_sub):
            own = np.flatnonzero(sub == s)
            at = np.flatnonzero(sub[i] == s)
            place = np.searchsorted(own, i[at])
            row = (lo, hi, s, cols_a[own], norm_a[own] ** 2, cols_b, norm_b ** 2, place, j[at], d[at])
            for name, value in zip(PART_FIELDS, row):
                out[name].append(value)
        return pd.DataFrame(out)
    return run


def _sub_block(cols: np.ndarray, n_sub: int) -> np.ndarray:
    """Sub-block of each column id: the same in every row-group."""
    mixed = (cols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (mixed % np.uint64(n_sub)).astype(np.int64)


def _reduce_parts(k: int | None, max_cells: int = MAX_ACC_CELLS, unit: bool = True):
    """Reducer of one sub-block: adds the row-groups' shares, then scores and keeps each column's best."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["lo"].iat[0]), int(pdf["hi"].iat[0])
        cols_a, norm_a = _summed(pdf["ca"], pdf["qa"])
        cols_b, norm_b = _summed(pdf["cb"], pdf["qb"])
        if not unit:
            norm_a, norm_b = np.ones(len(cols_a)), np.ones(len(cols_b))
        dense = len(cols_a) * len(cols_b) <= max_cells
        acc = np.zeros(len(cols_a) * len(cols_b)) if dense else None
        codes, sums = [], []
        for ca, cb, i, j, d in zip(pdf["ca"], pdf["cb"], pdf["i"], pdf["j"], pdf["d"]):
            if not len(d):
                continue
            code = np.searchsorted(cols_a, ca)[i] * len(cols_b) + np.searchsorted(cols_b, cb)[j]
            if dense:
                acc[code] += d  # a share holds each pair once
            else:
                codes.append(code)
                sums.append(d)
        if dense:
            return _cosine_topk(lo, hi, cols_a, cols_b, acc.reshape(len(cols_a), len(cols_b)), norm_a, norm_b, k)
        u, inv = np.unique(np.concatenate(codes) if codes else np.zeros(0, np.int64), return_inverse=True)
        total = np.bincount(inv, np.concatenate(sums), len(u)) if codes else np.zeros(0)
        return _sparse_cosine_topk(lo, hi, cols_a, cols_b, (u // len(cols_b), u % len(cols_b), total), norm_a, norm_b, k)
    return run


def _summed(cols, squares) -> tuple[np.ndarray, np.ndarray]:
    """Distinct column ids of all shares, and their lengths over all row-groups."""
    names, at = np.unique(np.concatenate(list(cols)), return_inverse=True)
    return names, np.sqrt(np.bincount(at, np.concatenate(list(squares)), len(names)))


def _top_mask(sim: np.ndarray, k: int) -> np.ndarray:
    """Per row: the ``k`` best positive entries under (score rounded to 8 dp desc, column asc).

    Columns of a tile are sorted by id, so this is exactly the global order
    (score, then id): the union of per-tile results contains every row's
    global top-``k``, and exactly ``k`` entries per row leave the tile.
    """
    pos = sim > 0
    if sim.shape[1] <= k:
        return pos
    r = np.where(pos, np.round(sim, RANK_DIGITS), -np.inf)
    kth = -np.partition(-r, k - 1, axis=1)[:, k - 1]
    greater = r > kth[:, None]
    equal = r == kth[:, None]
    need = k - greater.sum(axis=1)
    keep = greater | (equal & (np.cumsum(equal, axis=1) <= need[:, None]))
    return keep & pos


def _tile_cosine_topk(k: int | None, max_cells: int = MAX_ACC_CELLS, unit: bool = True):
    """Tile kernel when one row-group holds all rows: exact cosine (or dot, if not ``unit``) + per-column top-k."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi, cols_a, cols_b, acc, norm_a, norm_b = _block_product(pdf, max_cells)
        if not unit:
            norm_a, norm_b = np.ones(len(cols_a)), np.ones(len(cols_b))
        if isinstance(acc, tuple):
            return _sparse_cosine_topk(lo, hi, cols_a, cols_b, acc, norm_a, norm_b, k)
        return _cosine_topk(lo, hi, cols_a, cols_b, acc, norm_a, norm_b, k)
    return run


def _cosine_topk(lo, hi, cols_a, cols_b, acc, norm_a, norm_b, k: int | None) -> pd.DataFrame:
    """Best positive cosines of each column of a dense block product; of both sides, unless the blocks are one."""
    with np.errstate(divide="ignore", invalid="ignore"):
        sim = acc / np.outer(norm_a, norm_b)
    sim[~np.isfinite(sim)] = 0.0
    if lo == hi:
        _, at_a, at_b = np.intersect1d(cols_a, cols_b, assume_unique=True, return_indices=True)
        sim[at_a, at_b] = 0.0
    keep = sim > 0 if k is None else _top_mask(sim, k)
    i, j = np.nonzero(keep)
    out_i, out_j, out_s = [cols_a[i]], [cols_b[j]], [sim[i, j]]
    if lo != hi:
        keep_t = sim.T > 0 if k is None else _top_mask(sim.T, k)
        j2, i2 = np.nonzero(keep_t)
        out_i.append(cols_b[j2])
        out_j.append(cols_a[i2])
        out_s.append(sim[i2, j2])
    sims = np.concatenate(out_s)
    return pd.DataFrame({"i": np.concatenate(out_i).astype(np.int64),
                         "j": np.concatenate(out_j).astype(np.int64),
                         "sim": sims, "sim_r": np.round(sims, RANK_DIGITS)})


def _sparse_cosine_topk(lo, hi, cols_a, cols_b, acc, norm_a, norm_b, k):
    i, j, d = acc
    with np.errstate(divide="ignore", invalid="ignore"):
        sim = d / (norm_a[i] * norm_b[j])
    ok = np.isfinite(sim) & (sim > 0) & ((cols_a[i] != cols_b[j]) if lo == hi else True)
    i, j, sim = i[ok], j[ok], sim[ok]
    if k is None:
        keep_a = np.ones(len(i), dtype=bool)
    else:
        keep_a = _topk_sparse(i, j, sim, k)
    out_i, out_j, out_s = [cols_a[i[keep_a]]], [cols_b[j[keep_a]]], [sim[keep_a]]
    if lo != hi:
        keep_b = np.ones(len(i), dtype=bool) if k is None else _topk_sparse(j, i, sim, k)
        out_i.append(cols_b[j[keep_b]]); out_j.append(cols_a[i[keep_b]]); out_s.append(sim[keep_b])
    sims = np.concatenate(out_s)
    return pd.DataFrame({"i": np.concatenate(out_i).astype(np.int64),
                         "j": np.concatenate(out_j).astype(np.int64),
                         "sim": sims, "sim_r": np.round(sims, RANK_DIGITS)})


def plan_tiles(n_cols: int, n_entries: int, parallelism: int,
               tile_entries: int = TILE_ENTRIES, largest: int = 0) -> tuple[int, int]:
    """Choose (column blocks ``nb``, row-groups ``P``).

    Prefer ``P = 1`` (every tile sees all rows, so cosine and top-k finish
    inside the tile).  ``nb`` grows until tiles hold ``tile_entries`` and there
    are enough tiles for the cluster, capped at ``MAX_BLOCKS`` copies per entry;
    past that, rows are split into ``P`` groups whose partial sums are added.
    ``largest`` is the size of the largest column: one that fills a tile alone
    is split over row-groups too.
    """
    nb = max(1, math.ceil(n_cols / MAX_COL_BLOCK), math.ceil(2 * n_entries / tile_entries) - 1)
    while nb * (nb + 1) // 2 < 2 * parallelism and nb < n_cols and nb < MAX_BLOCKS:
        nb += 1
    nb = max(1, min(nb, MAX_BLOCKS, max(n_cols, 1)))
    p = max(1, math.ceil(2 * n_entries / ((nb + 1) * tile_entries)), math.ceil(largest / tile_entries))
    return nb, p


def _entries(entries: DataFrame, row: str, col: str, value: str) -> DataFrame:
    return entries.select(F.col(row).alias("r"), F.col(col).cast("long").alias("c"), F.col(value).cast("double").alias("v"))


def _tiles(entries: DataFrame, row: str, col: str, value: str, tile_entries: int, only: DataFrame | None = None):
    """(grouped tile rows, row-groups).  With ``only`` (its first column), tiles hold a block of these columns.

    They take blocks of their own, numbered first; their entries go to every
    tile of their block, all others to the tiles shared with those blocks.
    """
    e = _entries(entries, row, col, value)
    sizes = e.groupBy("c").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("nc"), F.sum("n").alias("n"), F.max("n").alias("largest")).first()
    par = entries.sparkSession.sparkContext.defaultParallelism
    nb, p = plan_tiles(sizes["nc"], sizes["n"] or 0, par, tile_entries, sizes["largest"] or 0)
    block, first = F.pmod(F.xxhash64("c"), F.lit(nb)), F.lit(nb)
    n_tiles = p * nb * (nb + 1) // 2
    if only is not None:
        asked = only.select(F.col(only.columns[0]).cast("long").alias("c")).distinct().withColumn("asked", F.lit(True))
        own = max(1, math.ceil(asked.count() / MAX_COL_BLOCK))
        e = e.join(asked, "c", "left")
        block = F.when(F.col("asked"), F.pmod(F.xxhash64("c"), F.lit(own))).otherwise(own + block)
        first = F.when(F.col("asked"), F.lit(own + nb)).otherwise(F.lit(own))
        n_tiles = p * (own * (own + 1) // 2 + own * nb)
    placed = e.select("r", "c", "v", block.alias("blk"), F.pmod(F.xxhash64("r"), F.lit(p)).alias("p"),
                      F.explode(F.sequence(F.lit(0).cast("long"), first.cast("long") - 1)).alias("other"))
    tiles = placed.select(
        "r", "c", "v", "blk", "p",
        F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"))
    # an explicit count keeps AQE from packing the (few, compute-heavy) tiles
    # into one task; the grouping reuses this layout
    return tiles.repartition(min(2 * n_tiles, 16 * par), "p", "lo", "hi").groupBy("p", "lo", "hi"), p


def column_norms(entries: DataFrame, col: str, value: str) -> DataFrame:
    return entries.groupBy(F.col(col).cast("long").alias("c")).agg(
        F.sqrt(F.sum(F.col(value).cast("double") * F.col(value).cast("double"))).alias("norm"))


def _divided(dots: DataFrame, norms: DataFrame) -> DataFrame:
    """``(a, b, sim)``: dots over both columns' norms."""
    na = norms.select(F.col("c").alias("a"), F.col("norm").alias("na"))
    nb = norms.select(F.col("c").alias("b"), F.col("norm").alias("nb"))
    return (dots.join(na, "a").join(nb, "b").filter((F.col("na") > 0) & (F.col("nb") > 0))
            .select("a", "b", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("sim")))


def cosine_of(pairs: DataFrame, entries: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """``(a, b, sim)`` of the named column pairs ``(a, b)`` that share a row: only their entries are joined."""
    e = entries.select(F.col(row).alias("r"), F.col(col).cast("long").alias("c"), F.col(value).cast("double").alias("v"))
    asked = pairs.select("a", "b").distinct()
    left = asked.join(e.select(F.col("c").alias("a"), "r", F.col("v").alias("va")), "a")
    both = left.join(e.select(F.col("c").alias("b"), "r", F.col("v").alias("vb")), ["b", "r"])
    dots = both.groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot"))
    return _divided(dots, column_norms(entries, col, value))


def cosine_pairs(entries: DataFrame, row: str, col: str, value: str, top_k: int | None = None,
                 tile_entries: int = TILE_ENTRIES, max_acc_cells: int = MAX_ACC_CELLS,
                 unit: bool = True, only: DataFrame | None = None, ranked: bool = False, write: bool = False) -> DataFrame:
    """Cosine of co-occurring column pairs, both directions: ``(i, j, sim, sim_r)``; the plain dot if not ``unit``.

    ``only``: just the pairs with an end in these columns.  A table where few
    of all column pairs meet is worked off row by row (``rowwise``).

    With ``top_k`` the result may be pruned to a superset of each column's
    ``top_k`` best neighbours (ties included); callers rank it exactly.  With
    ``ranked`` there is a ``rank`` column in place of ``sim_r`` if every list left its
    task whole; with ``write`` such lists are written.
    """
    if only is None and top_k is not None:
        e = _entries(entries, row, col, value)
        size = lambda key: e.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        cols = size("c").agg(F.count(F.lit(1)).alias("nc"), F.sum("n").alias("n"), F.max("n").alias("largest")).first()
        pairs = size("r").agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0
        if cols["n"] and rowwise.is_sparse(cols["nc"], pairs, cols["largest"], cols["n"]):
            return rowwise.top_pairs(e, cols["n"], pairs, top_k, unit, ranked, write)
    grouped, p = _tiles(entries, row, col, value, tile_entries, only)
    if p == 1:
        return grouped.applyInPandas(_tile_cosine_topk(top_k, max_acc_cells, unit), SIM_SCHEMA)
    # as many sub-blocks as row-groups: a reducer holds no more cells than a tile did
    parts = grouped.applyInPandas(_tile_parts(p, max_acc_cells), PART_SCHEMA)
    return parts.groupBy("lo", "hi", "sub").applyInPandas(_reduce_parts(top_k, max_acc_cells, unit), SIM_SCHEMA)


# --- left x right scoring with per-row top-N (profiles x catalog) -----------

USER_BLOCK = 2048         # users per scoring tile
ITEM_BLOCK = 4096         # distinct item vectors per scoring tile
SCORE_SCHEMA = "u long, i long, score double, score_r double, size long, need long"


DENSE_RATIO = 256         # a BLAS multiply-add is ~this much cheaper than one enumerated pair
GATHER_RATIO = 8          # a gathered multiply-add (dense side x sparse side) vs one pair
DENSE_MAX_CELLS = 20_000_000  # cells of a dense operand at most (doubles)
GATHER_CHUNK = 4_000_000  # gathered cells materialised at once


def _gather(ia, ca, va, ib, cb, vb, na: int, nb: int, n_keys: int) -> np.ndarray:
    """Dense A (keys x na, row per key) times sparse B: gather A's key rows per B entry.

    Work is ``na * len(B entries)`` with contiguous row gathers and a
    ``reduceat`` per b column: no pair enumeration, no dense B.
    """
    at = np.zeros((n_keys, na))
    at[ia, ca] = va
    order = np.argsort(cb, kind="stable")
    kb, vb_s, cb_s = ib[order], vb[order], cb[order]
    acc_t = np.zeros((nb, na))
    step = max(1, GATHER_CHUNK // max(na, 1))
    begin = 0
    n = len(kb)
    while begin < n:
        end = min(n, begin + step)
        while end < n and cb_s[end] == cb_s[end - 1]:   # keep whole columns inside a chunk
            end += 1
        cols = cb_s[begin:end]
        starts = np.flatnonzero(np.r_[True, cols[1:] != cols[:-1]])
        g = at[kb[begin:end]] * vb_s[begin:end, None]
        acc_t[cols[starts]] = np.add.reduceat(g, starts, axis=0)
        begin = end
    return acc_t.T


def _accumulate(ka, ca, va, kb, cb, vb, na: int, nb: int) -> np.ndarray:
    """``acc[a, b] = sum over shared keys k of va * vb`` as an ``(na, nb)`` array.

    Exact strategies, chosen per tile by estimated cost: a dense ``A @ B``
    over the tile's keys (BLAS) when both operands are small and dense; a
    dense-times-sparse gather when one side is dense; else a sparse product
    that enumerates co-occurring entries key by key in chunks of bounded size
    and sums them with ``bincount``.
    """
    keys = np.unique(np.concatenate([ka, kb]))
    ia = np.searchsorted(keys, ka)
    ib = np.searchsorted(keys, kb)
    n_keys = len(keys)
    cnt_a = np.bincount(ia, minlength=n_keys)
    cnt_b = np.bincount(ib, minlength=n_keys)
    pairs = int((cnt_a.astype(np.int64) * cnt_b).sum())
    if pairs == 0:
        return np.zeros((na, nb))
    dense = na * nb * n_keys / DENSE_RATIO if (na + nb) * n_keys <= DENSE_MAX_CELLS else np.inf
    gather_a = na * len(kb) / GATHER_RATIO if na * n_keys <= DENSE_MAX_CELLS else np.inf
    gather_b = nb * len(ka) / GATHER_RATIO if nb * n_keys <= DENSE_MAX_CELLS else np.inf
    best = min(dense, gather_a, gather_b, pairs)
    if best == dense:
        a = np.zeros((na, n_keys))
        a[ca, ia] = va
        b = np.zeros((n_keys, nb))
        b[ib, cb] = vb
        return a @ b
    if best == gather_a:
        return _gather(ia, ca, va, ib, cb, vb, na, nb, n_keys)
    if best == gather_b:
        return _gather(ib, cb, vb, ia, ca, va, nb, na, n_keys).T
    acc = np.zeros(na * nb, dtype=np.float64)
    for ai, bi, prod in _pair_chunks(ka, ca, va, kb, cb, vb):
        acc += np.bincount(ai.astype(np.int64) * nb + bi, weights=prod, minlength=na * nb)
    return acc.reshape(na, nb)


def _unpack(rows: pd.DataFrame):
    """(row number, key, value) of every entry of packed rows."""
    n = rows["t"].map(len).to_numpy()
    at = np.repeat(np.arange(len(rows)), n)
    return at, np.concatenate(list(rows["t"])), np.concatenate(list(rows["v"])).astype(np.float64)


def _needed(r: np.ndarray, positive: np.ndarray, size: np.ndarray, need: np.ndarray):
    """(user, item) positions whose better-scored items of the tile are together fewer than ``need[user]``."""
    m = r.shape[1]  # every vector counts at least once, so a user's ``need`` best scores (with ties) hold them all
    best = lambda row, k: np.partition(row, m - k)[m - k] if k < m else 0.0
    usual = 2 * -(-need // max(1, int(size.mean()))) + 8  # where many items share a vector, far fewer do
    kth = np.array([best(row, k) for row, k in zip(r, np.minimum(need, usual))])
    short = np.flatnonzero((usual < need) & ((r >= kth[:, None]) @ size.astype(np.float64) < need))
    kth[short] = [best(r[x], need[x]) for x in short]
    u, c = np.nonzero(positive & (r >= kth[:, None]))
    if not len(u):
        return u, c
    order = np.lexsort((-r[u, c], u))
    u, c = u[order], c[order]
    level, ahead = r[u, c], np.cumsum(size[c]) - size[c]
    user_start = np.r_[True, u[1:] != u[:-1]]
    level_start = user_start | np.r_[True, level[1:] != level[:-1]]
    before = ahead[level_start][np.cumsum(level_start) - 1] - ahead[user_start][np.cumsum(user_start) - 1]
    keep = before < need[u]
    return u[keep], c[keep]


def _score_tile(pdf: pd.DataFrame) -> pd.DataFrame:
    """Cosine of each user of a tile with each of its item vectors; every vector that may reach the user's list."""
    left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    out = dict.fromkeys(["u", "i", "score", "score_r", "size", "need"], np.zeros(0))
    if len(left) and len(right):
        ul, tl, vl = _unpack(left)
        ir, tr, vr = _unpack(right)
        score = _accumulate(tl, ul, vl, tr, ir, vr, len(left), len(right))
        norms = np.outer(np.sqrt(np.bincount(ul, vl * vl, len(left))), np.sqrt(np.bincount(ir, vr * vr, len(right))))
        score = np.divide(score, norms, out=np.zeros_like(score), where=norms > 0)
        r = np.round(score, RANK_DIGITS)
        size, need = right["n"].to_numpy(), left["n"].to_numpy()
        u, c = _needed(r, score > 0, size, need)
        out = {"u": left["a"].to_numpy()[u], "i": right["a"].to_numpy()[c], "score": score[u, c], "score_r": r[u, c],
               "size": size[c], "need": need[u]}
    return pd.DataFrame(out)


def score_vectors(left: DataFrame, right: DataFrame, n_users: int, n_items: int) -> DataFrame:
    """Positive cosine scores of users with distinct item vectors, as far as a user's list can need them.

    ``left(a, t, v, n)`` holds a user per row (keys ``t`` and values ``v`` as
    arrays) and how many items it needs; ``right(a, t, v, n)`` an item vector
    per row and how many items share it.  Tiles are (user block, item block):
    users are copied to every item block and item vectors to every user block.
    A user's vector is bounded by the vocabulary, so no tile grows with a heavy
    user.  A vector leaves its tile if fewer than ``need`` items of the tile
    score better, which any list of ``need`` items is covered by.
    """
    par = left.sparkSession.sparkContext.defaultParallelism
    n_ib = max(1, math.ceil(n_items / ITEM_BLOCK))
    n_ub = min(max(1, n_users), max(math.ceil(n_users / USER_BLOCK), math.ceil(2 * par / n_ib)))
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    block = lambda m: F.pmod(F.xxhash64("a"), F.lit(m))
    packed = ["a", "t", "v", F.col("n").cast("long").alias("n")]
    rows = (left.select(block(n_ub).alias("ub"), every(n_ib).alias("ib"), F.lit(0).alias("side"), *packed)
            .unionByName(right.select(every(n_ub).alias("ub"), block(n_ib).alias("ib"), F.lit(1).alias("side"), *packed)))
    tiles = rows.repartition(min(2 * n_ub * n_ib, 16 * par), "ub", "ib")   # tiles spread evenly (see _tiles)
    return tiles.groupBy("ub", "ib").applyInPandas(_score_tile, SCORE_SCHEMA)
