"""Exact top-k search (1): distributed histogram selection of each query's k-th score.

Candidates are packed into integer blocks; every pass scores all blocks against
all query blocks.  The histogram passes count scores in ``BINS`` bins of each
query's current range, add the counts over all blocks, and narrow the range to
the bin that holds the k-th best, until the bin is one score wide.  A last pass
keeps the scores from that value on and breaks ties by the smaller id.  A block
never emits bins below its own k-th best score, nor more than k ties: neither
can hold a result.

Query blocks join candidate blocks by block number.  The query side is
broadcast while its measured size stays under ``BROADCAST_BYTES``; beyond that
the same join shuffles the blocks.

Defined cases: a vector that is null, empty, or holds a null or non-finite
component takes no part, nor does a row with a null id; a score that could pass
2**62 (by the product of the largest lengths) is an error; only vectors of equal length are scored against each
other; rows with the query's own id are not its candidates; of repeated query
ids the smallest vector asks; repeated candidate rows rank as often as they
occur; fewer than k candidates give them all; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import staged

BINS = 1024
BLOCK_ROWS = 4096
QUERY_BLOCK = 256
LARGEST = float(1 << 62)  # a vector of this length fails the bound on scores, whatever it meets
BROADCAST_BYTES = 64 << 20
BLOCK_SCHEMA = "dim int, n int, ids binary, vectors binary, norm double"
HIST_SCHEMA = "query_id long, bin int, n long"
HIT_SCHEMA = "query_id long, vec_id long, score long"


def quantised(vector: np.ndarray, scale: int) -> np.ndarray | None:
    """The integer vector, None if it takes no part; components that no integer product could use come out as the largest."""
    out = np.floor(scale * vector.astype(np.float64))
    if not len(out) or not np.isfinite(vector).all():
        return None
    return out.astype(np.int32) if np.abs(out).max() < 1 << 31 else np.clip(out, -LARGEST, LARGEST).astype(np.int64)


def unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    """The integers of a block, 4 or 8 bytes each."""
    return np.frombuffer(data, f"<i{len(data) // (rows * dim)}").reshape(rows, dim)


def _blocks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """(id, vector) rows as blocks of equal-length integer vectors."""
    for batch in batches:
        by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
        column = batch.column(1)
        for i, key in enumerate(batch.column(0).to_pylist()):
            value = column[i]
            if key is None or not value.is_valid or value.values.null_count:
                continue
            vector = quantised(value.values.to_numpy(zero_copy_only=False), scale)
            if vector is not None:
                by_dim.setdefault(len(vector), []).append((key, vector))
        for dim, rows in by_dim.items():
            for a in range(0, len(rows), BLOCK_ROWS):
                part = rows[a:a + BLOCK_ROWS]
                m = np.stack([v for _, v in part])
                norm = float(np.sqrt((m.astype(np.float64) ** 2).sum(1)).max())
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([dim], pa.int32()), "n": pa.array([len(part)], pa.int32()),
                    "ids": pa.array([np.array([k for k, _ in part], np.int64).tobytes()], pa.binary()),
                    "vectors": pa.array([m.tobytes()], pa.binary()), "norm": pa.array([norm], pa.float64())})


def candidate_blocks(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long"), vector_col)
    return rows.mapInArrow(partial(_blocks, scale=scale), BLOCK_SCHEMA)


def _queries(blocks: DataFrame, pick) -> DataFrame:
    """One row per query id: (query_id, dim, v) with the smallest vector of repeated ids."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                m = unpacked(r["vectors"], len(ids), r["dim"])
                keep = np.flatnonzero(pick(ids))
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(ids[keep]), "dim": pa.array([r["dim"]] * len(keep), pa.int32()),
                    "v": pa.array([x.tobytes() for x in m[keep]], pa.binary()),
                    "norm": pa.array(np.sqrt((m[keep].astype(np.float64) ** 2).sum(1)))})

    rows = blocks.mapInArrow(unpack, "query_id long, dim int, v binary, norm double")
    return rows.groupBy("query_id").agg(F.min(F.struct("v", "dim", "norm")).alias("q")).select("query_id", "q.*")


def _scores(vectors: np.ndarray, queries: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer products: in float32 or float64 while every partial sum fits its mantissa."""
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return (vectors.astype(kind) @ queries.astype(kind).T).astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch], k: int):
    """Scores of each joined (candidate block, query block), with the block's own k-th best per query."""
    for batch in batches:
        for r in batch.to_pylist():
            ids = np.frombuffer(r["ids"], np.int64)
            m = unpacked(r["vectors"], len(ids), r["dim"])
            q = np.concatenate([unpacked(x["v"], 1, r["dim"]) for x in r["queries"]])
            qid = np.array([x["query_id"] for x in r["queries"]], np.int64)
            low = np.array([x["low"] for x in r["queries"]], np.int64)
            width = np.array([x["width"] for x in r["queries"]], np.int64)
            bound = r["norm"] * max(x["norm"] for x in r["queries"]) + 1
            s = _scores(m, q, bound)
            own = ids[:, None] == qid[None, :]
            s[own] = np.iinfo(np.int64).min
            floor = np.partition(s, len(ids) - k, axis=0)[len(ids) - k] if len(ids) > k else s.min(0)
            yield ids, qid, low, width, s, ~own, floor


def _histogram(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Counts by bin of each query's range; scores above the range count in the bin on top of it."""
    for _, qid, low, width, s, valid, floor in _pairs(batches, k):
        lowest = np.maximum(low, floor)
        use = valid & (s >= lowest)
        row, col = np.nonzero(use)
        bins = np.minimum((s[row, col] - low[col]) // width[col], BINS)
        counts = np.bincount(col * (BINS + 1) + bins, minlength=len(qid) * (BINS + 1))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "query_id": pa.array(qid[at // (BINS + 1)]), "bin": pa.array((at % (BINS + 1)).astype(np.int32)),
            "n": pa.array(counts[at])})


def _selected(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Scores from the k-th value (``low``) on; of the block's ties at it the k smallest ids."""
    for ids, qid, low, _, s, valid, floor in _pairs(batches, k):
        row, col = np.nonzero(valid & (s >= np.maximum(low, floor)))
        score = s[row, col]
        order = np.lexsort((ids[row], -score, col))
        row, col, score = row[order], col[order], score[order]
        first = np.searchsorted(col, np.arange(len(qid)))
        held = np.arange(len(col)) - first[col] < k
        yield pa.RecordBatch.from_pydict({
            "query_id": pa.array(qid[col[held]]), "vec_id": pa.array(ids[row[held]]), "score": pa.array(score[held])})


def top_k(vectors: DataFrame, pick, k: int, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` best rows; ``pick(ids)`` marks the query ids."""
    if k < 1:
        raise ValueError("k must be positive")
    blocks = staged(candidate_blocks(vectors, id_col, vector_col, scale), "vectors")
    queries = staged(_queries(blocks, pick), "queries")
    size, longest = queries.agg(F.sum(F.length("v") + 40), F.max("norm")).first()
    reach = blocks.agg(F.max("norm")).first()[0]
    if not size:
        return blocks.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if longest * reach >= 2.0 ** 62:
        raise ValueError("the integer products of these vectors may not fit 64 bits; use a smaller scale")
    bound = int(longest * reach) + 1
    width = 1
    while width * BINS < 2 * bound + 1:
        width *= BINS
    n_blocks = queries.count() // QUERY_BLOCK + 1

    def paired(state: DataFrame, kernel, schema: str) -> DataFrame:
        q = state.groupBy("dim", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).alias("block")).agg(
            F.collect_list(F.struct("query_id", "v", "norm", "low", "width")).alias("queries"))
        q = F.broadcast(q) if size <= BROADCAST_BYTES else q
        spread = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>")))
        return spread.join(q, ["dim", "block"]).select("ids", "vectors", "dim", "norm", "queries").mapInArrow(
            partial(kernel, k=k), schema)

    state = queries.withColumn("low", F.lit(-bound).cast("long")).withColumn("width", F.lit(width).cast("long"))
    while True:
        counts = paired(state, _histogram, HIST_SCHEMA).groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        kth = (counts.withColumn("above", F.sum("n").over(down)).filter(F.col("above") >= k)
               .groupBy("query_id").agg(F.max("bin").alias("bin")))
        low: Column = F.col("low") + F.coalesce("bin", F.lit(0)) * F.col("width")
        state = staged(state.join(kth, "query_id", "left").withColumn("low", low)
                       .withColumn("width", F.lit(max(1, width // BINS)).cast("long")).drop("bin"), "range")
        if width == 1:
            break
        width //= BINS
    hits = paired(state, _selected, HIT_SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
