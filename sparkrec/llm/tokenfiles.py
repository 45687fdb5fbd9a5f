"""Token-id files (10): concatenated ids with Elias-Fano coded document boundaries.

A file holds a run of whole documents in ascending ``doc_id`` order: a header,
the boundaries and the (non-decreasing) document ids as Elias-Fano sequences
with sampled select positions, then the ids in 2 or 4 bytes each.  Boundaries
cost about ``2 + log2(ids per document)`` bits each instead of 64.  Spark
range-partitions and sorts the documents, each task writes its run, and Spark's
text writer commits one record per file (its line feed is the end mark), so
retried tasks leave no half file and any Spark file system will do.

Defined cases: a null or empty text is the end id alone; documents with a null
``doc_id`` come first; repeated rows are written as often as they occur, equal
ids in the order of their text hash; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import pieces, slices
from sparkrec.llm.encode import BLOCK_CHARS, encoder

MAGIC = b"TOKENEF1"
HEADER = struct.Struct("<8s8q")  # magic, part, seq, documents, null ids, first id, ids, id width, reserved
EF_HEADER = struct.Struct("<4q")  # values, low bits, bytes of high bits, samples
SAMPLE = 64
SHARD_IDS = 1 << 21
DOC_SCHEMA = "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def ef_encode(values: np.ndarray) -> bytes:
    """Elias-Fano bytes of a non-decreasing array of non-negative integers (as unsigned 64-bit)."""
    n = len(values)
    values = values.astype(np.uint64)
    top = int(values[-1]) if n else 0
    low = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    bits[high] = 1
    lows = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    highs = np.packbits(bits, bitorder="little").tobytes()
    samples = high[::SAMPLE].astype("<u4")
    return EF_HEADER.pack(n, low, len(highs), len(samples)) + samples.tobytes() + highs \
        + np.packbits(lows, bitorder="little").tobytes()


class EliasFano:
    """Reads one sequence from ``data`` at ``at``; ``end`` is the first byte after it."""

    def __init__(self, data: bytes, at: int = 0):
        self.n, self.low, n_high, n_samples = EF_HEADER.unpack_from(data, at)
        at += EF_HEADER.size
        self.samples = np.frombuffer(data, "<u4", n_samples, at)
        at += 4 * n_samples
        self.high = np.frombuffer(data, np.uint8, n_high, at)
        at += n_high
        n_low = (self.n * self.low + 7) // 8
        self.lows = np.frombuffer(data, np.uint8, n_low, at)
        self.end = at + n_low

    def _low(self, i: int) -> int:
        first = i * self.low
        chunk = int.from_bytes(self.lows[first // 8:(first + self.low + 7) // 8].tobytes(), "little")
        return chunk >> first % 8 & (1 << self.low) - 1

    def select(self, i: int) -> int:
        """Value ``i``: start at the sampled one-bit before it, then count ones."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        word = int(self.high[byte]) >> at % 8 << at % 8
        while left >= (ones := word.bit_count()):
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        position = byte * 8 + (word & -word).bit_length() - 1
        return (position - i) << self.low | self._low(i)

    def all(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little")) - np.arange(self.n)
        bits = np.unpackbits(self.lows, bitorder="little")[:self.n * self.low].reshape(self.n, self.low)
        low = (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return (high.astype(np.uint64) << np.uint64(self.low)) | low


def shard_bytes(part: int, seq: int, doc_ids: list[int | None], lengths: list[int], ids: bytes, width: int) -> bytes:
    nulls = sum(d is None for d in doc_ids)
    known = doc_ids[nulls:]
    first = known[0] if known else 0
    gaps = np.array([(d - first) % (1 << 64) for d in known], np.uint64)
    starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    tokens = np.frombuffer(ids, "<u4")
    head = HEADER.pack(MAGIC, part, seq, len(doc_ids), nulls, first, len(tokens), width, 0)
    return head + ef_encode(starts) + ef_encode(gaps) + tokens.astype(f"<u{width}").tobytes()


class TokenFile:
    """One shard: ``doc(i)`` gives the ids of its i-th document through select, without a table."""

    def __init__(self, data: bytes):
        magic, self.part, self.seq, self.n, self.nulls, self.first, self.n_ids, self.width, _ = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.starts = EliasFano(data, HEADER.size)
        self.gaps = EliasFano(data, self.starts.end)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, self.gaps.end)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.gaps.select(i - self.nulls) + self.first

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [int(g) + self.first for g in self.gaps.all()]

    def doc(self, i: int) -> np.ndarray:
        return self.ids[self.starts.select(i):self.starts.select(i + 1)]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int,
                      shard_ids: int = SHARD_IDS, added_tokens: bool = False) -> None:
    """Encode, sort and write every document; a file closes when it holds ``shard_ids`` ids."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, added_tokens)
        width = 2 if max(enc.vocabulary, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        names: list = []
        lengths: list[int] = []
        held: list[bytes] = []
        total = 0

        def close() -> pa.RecordBatch:
            data = shard_bytes(part, seq, names, lengths, b"".join(held), width)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["payload"])

        for batch in pieces(batches, 5000):
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t) for t in texts], BLOCK_CHARS):
                for doc, ids in zip(docs[a:b], enc.encode_all(texts[a:b])):
                    names.append(doc)
                    lengths.append(len(ids) // 4 + 1)
                    held.append(ids + end)
                    total += lengths[-1]
                    if total >= shard_ids:
                        yield close()
                        seq += 1
                        names, lengths, held, total = [], [], [], 0
        if names:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = rows.withColumn("h", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    (ordered.mapInArrow(build, "payload binary")
     .select(F.col("payload").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under ``path`` with its place in its file (``DOC_SCHEMA``)."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                f = TokenFile(content.as_py())
                starts = f.starts.all().astype(np.int64)
                ids = f.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f.part] * f.n, pa.int32()), pa.array([f.seq] * f.n, pa.int32()),
                     pa.array(f.doc_ids(), pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)),
                     pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").load(path)
    return files.filter("length > 1").select("content").mapInArrow(parse, DOC_SCHEMA)


def with_global_start(rows: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before.  Sums run per file, per part, then over the few parts."""
    files = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("ids"))
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", "seq", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("file_start"))
    base = files.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("file_start")).alias("base"))
    return rows.join(base, ["part", "seq"]).withColumn("start", F.col("base") + F.col("local_start"))
