"""Packing (2): power-of-two decomposition of documents into single-document sequences.

A document's ids (with the end id) are cut into full windows and then into the
binary digits of the rest, so every piece has a power-of-two length, fills a
sequence of its own and needs no padding.  Pieces of equal length share a
bucket; a batch drawn from one bucket is rectangular.  There is no shuffle:
each task cuts the documents it has read.

Defined cases: a null or empty text is the end id alone; a null ``doc_id`` is
kept; repeated rows are packed as often as they occur; an empty table gives no
pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import pieces, slices
from sparkrec.llm.encode import BLOCK_CHARS, encoder

SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary"
WINDOW = 2048


def piece_lengths(n: int, window: int) -> list[int]:
    """``n`` as full windows followed by the powers of two of the remainder, largest first."""
    full, rest = divmod(n, window)
    return [window] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW,
         added_tokens: bool = False) -> DataFrame:
    """Pieces of all documents: ``SCHEMA`` plus ``bucket`` (log2 of the length), ``sequence_id`` and ``offset``.

    ``ids`` holds little-endian unsigned 32-bit ids; each piece is one whole sequence.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, added_tokens)
        end = np.array([end_id], "<u4").tobytes()
        for batch in pieces(batches, 5000):
            docs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices([len(t) for t in texts], BLOCK_CHARS):
                cols: list[list] = [[], [], [], [], []]
                for doc, ids in zip(docs[a:b], enc.encode_all(texts[a:b])):
                    ids += end
                    at, n = 0, len(ids) // 4
                    for length in piece_lengths(n, window):
                        row = (doc, at, length, n, ids[4 * at:4 * (at + length)])
                        for col, value in zip(cols, row):
                            col.append(value)
                        at += length
                yield to_batch(cols)

    def to_batch(cols: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          ["doc_id", "start", "length", "doc_tokens", "ids"])

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, SCHEMA)
    return (found
            .withColumn("bucket", F.log2("length").cast("int"))
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per piece length, ready for rectangular batches."""
    pieces.write.partitionBy("bucket").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")
