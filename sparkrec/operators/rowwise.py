"""Top-k cosine of sparse columns, row by row: tasks hold blocks of columns and the rows that touch them.

The tiles (``tiles``) copy every entry to each block of columns, which suits
tables where most columns meet.  In a large sparse table a column meets few
others; here a row (a user) is sent only to the blocks of its own columns, so
the shuffle follows the co-occurring pairs and grows with the input.  A block
has every entry of the rows of its columns, so cosine and top-k end inside the
task and only the lists leave it.

Rows are packed by ``pack``: all rows of a task that touch a block are one
record of column ids (as differences), values and squared column lengths, each
as byte planes, compressed.  The packed rows of a large table are sent in
rounds of blocks, so the disk holds those of one round at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.session import spread, stage, staged_parts, task_count

BLOCK_ENTRIES = 4_000_000  # entries in a block's rows, on average
PAIR_CHUNK = 4_000_000     # products held at once
ROUND_PAIRS = 2_000_000_000  # entries in the packed rows that are on disk at once
RANK_DIGITS = 8            # as in the tiles
PACK_SCHEMA = "blk long, rows long, entries long, payload binary"
TOP_SCHEMA = "i long, j long, sim double, sim_r double, rank int"


def is_sparse(n_cols: int, pairs: int, largest: int, n_entries: int) -> bool:
    """Whether blocks stay small: few of all column pairs meet, and no column brings too many rows to its block."""
    return 4 * pairs <= n_cols * n_cols and largest * pairs <= 4 * BLOCK_ENTRIES * max(n_entries, 1)


def block_of(cols: np.ndarray, n_blocks: int) -> np.ndarray:
    mixed = (cols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % np.uint64(n_blocks)).astype(np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions ``start[x] .. start[x] + size[x] - 1`` of all x, in order."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _planes(a: np.ndarray) -> bytes:
    return a.view(np.uint8).reshape(len(a), 8).T.tobytes()


def pack(size: np.ndarray, cols: np.ndarray, values: np.ndarray, squares: np.ndarray) -> bytes:
    """Compressed rows: their sizes, then column ids, values and squared column lengths of their entries."""
    steps = np.diff(cols, prepend=np.int64(0))
    raw = b"".join(map(_planes, (size.astype(np.int64), steps, values, squares)))
    return pa.compress(raw, codec="zstd", asbytes=True)


def unpack(payload: bytes, rows: int, entries: int):
    raw = np.frombuffer(pa.decompress(payload, 8 * (rows + 3 * entries), codec="zstd", asbytes=True), np.uint8)
    cuts = np.cumsum([0, rows, entries, entries, entries]) * 8
    flat = [np.ascontiguousarray(raw[a:b].reshape(8, -1).T).view(t).ravel()
            for a, b, t in zip(cuts[:-1], cuts[1:], (np.int64, np.int64, np.float64, np.float64))]
    return flat[0], np.cumsum(flat[1]), flat[2], flat[3]


def _row_starts(names: pa.Array) -> np.ndarray:
    """First positions of the runs of equal names (null equals null)."""
    if not len(names):
        return np.zeros(0, np.int64)
    a, b = names.slice(1), names.slice(0, len(names) - 1)
    differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(pc.is_null(a), pc.is_null(b)))
    return np.flatnonzero(np.append(True, differ.to_numpy(zero_copy_only=False)))


def _pack_task(n_blocks: int, part: int = 0, rounds: int = 1):
    """Rows ``(r, c, v, q)`` of a task, sorted by row -> one ``PACK_SCHEMA`` record per block of the round that they touch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        del held
        if not table.num_rows:
            return
        start = _row_starts(table["r"].combine_chunks())
        cols, values, squares = (table[x].to_numpy() for x in ("c", "v", "q"))
        size = np.diff(np.append(start, len(cols)))
        row = np.repeat(np.arange(len(start)), size)
        block = block_of(cols, n_blocks)
        met = np.unique((block * len(start) + row)[block % rounds == part])
        if not len(met):
            return
        block, row = met // len(start), met % len(start)
        cuts = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows = row[a:b]
            at = _ranges(start[rows], size[rows])
            data = pack(size[rows], cols[at], values[at], squares[at])
            yield pa.RecordBatch.from_arrays([pa.array([block[a]]), pa.array([b - a]), pa.array([len(at)]),
                                              pa.array([data], pa.binary())], ["blk", "rows", "entries", "payload"])
    return run


def _best(i, j, sim, k: int) -> np.ndarray:
    """Positions of the ``k`` best of each ``i`` by (rounded score desc, j asc), of pairs in order of (i, j)."""
    order = np.lexsort((-np.round(sim, RANK_DIGITS), i))
    i = i[order]
    first = np.maximum.accumulate(np.where(np.append(True, i[1:] != i[:-1]), np.arange(len(i)), 0))
    return order[np.arange(len(i)) - first < k]


def block_lists(block: int, n_blocks: int, records: list, k: int, unit: bool, chunk: int = PAIR_CHUNK) -> Iterator[tuple]:
    """``(i, j, sim)`` arrays: the ``k`` best positive partners of every column of a block, from its packed rows."""
    parts = [unpack(*x) for x in records]
    size, cols, values, squares = (np.concatenate(x) for x in zip(*parts))
    del parts
    names, at, col = np.unique(cols, return_index=True, return_inverse=True)
    length = np.sqrt(squares[at]) if unit else np.ones(len(names))
    del cols, squares
    start = np.cumsum(size) - size
    row = np.repeat(np.arange(len(size), dtype=np.int32), size)
    own = np.flatnonzero((block_of(names, n_blocks) == block)[col])
    own = own[np.argsort(col[own], kind="stable")]
    total = np.cumsum(size[row[own]])
    ends = np.append(np.flatnonzero(col[own][1:] != col[own][:-1]) + 1, len(own))  # after each column's entries
    begin = 0
    while begin < len(own):
        done = total[begin - 1] if begin else 0
        fits = ends[ends > begin]
        end = max(int(fits[0]), int(fits[np.searchsorted(total[fits - 1], done + chunk, side="right") - 1]))
        e = own[begin:end]
        begin = end
        reps = size[row[e]]
        other = _ranges(start[row[e]], reps)
        code = np.repeat(col[e].astype(np.int64), reps) * len(names) + col[other]
        product = np.repeat(values[e], reps) * values[other]
        order = np.argsort(code)
        code = code[order]
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        dot = np.add.reduceat(product[order], first)
        i, j = np.divmod(code[first], len(names))
        with np.errstate(divide="ignore", invalid="ignore"):
            sim = dot / (length[i] * length[j])
            ok = np.flatnonzero(np.isfinite(sim) & (sim > 0) & (i != j))
        i, j, sim = i[ok], j[ok], sim[ok]
        if len(i):
            best = _best(i, j, sim, k)
            yield names[i[best]], names[j[best]], sim[best]


def _lists_task(n_blocks: int, k: int, unit: bool):
    """Records of a task, sorted by block -> ``TOP_SCHEMA`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(block, records):
            for i, j, sim in block_lists(block, n_blocks, records, k, unit):
                place = np.arange(len(i))
                rank = place - np.maximum.accumulate(np.where(np.append(True, i[1:] != i[:-1]), place, 0)) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (i, j, sim, np.round(sim, RANK_DIGITS), rank.astype(np.int32))],
                    ["i", "j", "sim", "sim_r", "rank"])
        now, held = None, []
        for batch in batches:
            for record in zip(*(batch.column(x).to_pylist() for x in range(4))):
                if record[0] != now and held:
                    yield from lists(now, held)
                    held = []
                now = record[0]
                held.append((record[3], record[1], record[2]))
        if held:
            yield from lists(now, held)
    return run


def top_pairs(entries: DataFrame, n_entries: int, pairs: int, k: int, unit: bool = True, ranked: bool = True,
              write: bool = False) -> DataFrame:
    """``TOP_SCHEMA`` rows of ``entries(r, c, v)``: exactly each column's ``k`` best positive partners.

    A column's list is whole in its block, so ``rank`` is its final place there.
    ``pairs`` is the number of co-occurring entry pairs, which the number of
    blocks follows from.  Over ``ROUND_PAIRS`` of them, or with ``write``, the
    lists are written: with ``rank`` if ``ranked``, else with ``sim_r``.
    """
    spark = entries.sparkSession
    n_blocks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(pairs / BLOCK_ENTRIES))
    e = entries.filter(F.col("c").isNotNull()).withColumn("v", F.coalesce("v", F.lit(float("nan"))))
    e = spread(e, n_entries, "c").withColumn("q", F.sum(F.col("v") * F.col("v")).over(Window.partitionBy("c")))
    rounds = max(1, math.ceil(pairs / ROUND_PAIRS))
    if rounds > 1:
        e = stage(e)

    def lists(part: int) -> DataFrame:
        rows = e.repartition(task_count(e, n_entries), "r").sortWithinPartitions("r", "c")
        packed = rows.mapInArrow(_pack_task(n_blocks, part, rounds), PACK_SCHEMA)
        # an explicit count keeps AQE from packing several blocks into one task
        placed = packed.repartition(-(-n_blocks // rounds), "blk").sortWithinPartitions("blk")
        return placed.mapInArrow(_lists_task(n_blocks, k, unit), TOP_SCHEMA).drop("sim_r" if ranked else "rank")

    return staged_parts(rounds, lists) if write or rounds > 1 else lists(0)
