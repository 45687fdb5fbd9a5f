"""Near-duplicate detection (5): improved consistent weighted sampling over TF-IDF shingles, banded and verified.

1. Document frequencies of word shingles are counted over all documents in
   hashed buckets (a fixed number of counters, broadcast as weights).
2. Each text gets ``SAMPLES`` consistent weighted samples; two consecutive ones
   make a band key.  Equal word sequences collapse to one node here, so a large
   group of exact copies never meets a bucket.
3. In every bucket each node is compared with the bucket's most central nodes
   (those that share most buckets), and similar pairs are merged to components.
4. What a bucket then still holds of different components is compared
   completely, but for the nodes of its largest component among themselves:
   pairs whose samples agree often enough are verified.  Blocks hold at most
   ``BLOCK_NODES`` nodes a side and emit links, never pairs.

A link is verified on the whole texts: weighted Jaccard similarity of at least
``LEAST``, which every pair of plain similarity 0.8 has (and none under 0.774).  The class of a document is the least doc_id of its component.

Defined cases: rows with the same ``doc_id`` are one document; a null text, one
without words, or a null ``doc_id`` has no copies (class: its own id); texts of
fewer than five words are one shingle; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm import icws
from sparkrec.llm.common import by_group, join_by_size, pieces, staged
from sparkrec.llm.components import connected_components
from sparkrec.llm.shingles import U, blocks, digests, normal_bytes, shingles_of, words_of

LEAST = icws.least_weighted(0.8)
CENTRAL = 3  # nodes of a bucket that all its others are compared with first
AGREE = 10  # of SAMPLES: a pair of weighted similarity LEAST has fewer with probability 0.001
BLOCK_NODES = 4096
PAIR_BLOCK = 256
MARK = -1  # pseudo bucket that counts documents


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (bucket, documents' shingles in it), and the documents under ``MARK``."""
    counts, docs = np.zeros(1 << icws.BUCKET_BITS, np.int64), 0
    for batch in pieces(batches):
        for _, _, texts in blocks(batch.column(0).to_pylist()):
            s = shingles_of(words_of(texts))
            counts += np.bincount(icws.bucket(s.keys), minlength=len(counts))
            docs += int((np.diff(s.first) > 0).sum())
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, MARK).astype(np.int32)), pa.array(np.append(counts[at], docs))],
                                     ["bucket", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Weights of all buckets, from every document; the driver gets the fixed number of counters only."""
    sums = docs.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    counts = np.zeros(1 << icws.BUCKET_BITS, np.int64)
    counts[bucket[bucket >= 0]] = n[bucket >= 0]
    return icws.inverse_frequency(counts, int(n[bucket == MARK].sum()))


def signatures(docs: DataFrame, idf) -> DataFrame:
    """(doc_id, digest, bands) of every document with an id and words; ``idf`` is a broadcast of the weights."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b, normal in blocks(texts):
                words = words_of(normal)
                s = shingles_of(words)
                got = icws.samples(s, icws.weights(s, idf.value)).astype(U)
                keys = (got[:, ::2] << U(32) | got[:, 1::2]).astype(np.int64)
                out = pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(digests(normal), pa.binary()),
                     pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1], pa.array(keys.ravel()))],
                    ["doc_id", "digest", "bands"])
                yield out.filter(out.column(1).is_valid())

    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(sign, "doc_id long, digest binary, bands array<long>")


class Vectors:
    """Shingle weights of the texts of one block, and the similarity of pairs of them."""

    def __init__(self, texts: list[str], idf: np.ndarray):
        s = shingles_of(words_of([normal_bytes(t) for t in texts]))
        names, self.at = np.unique(s.keys, return_inverse=True)
        self.weight, self.first = icws.weights(s, idf), s.first
        self.total = np.add.reduceat(np.append(self.weight, 0), np.minimum(s.first[:-1], len(self.weight)))
        self.dense = np.zeros(len(names), np.float32)

    def similar(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` are similar to text ``i``, by weighted Jaccard similarity."""
        own = slice(self.first[i], self.first[i + 1])
        self.dense[self.at[own]] = self.weight[own]
        out = np.zeros(len(others), bool)
        for k, j in enumerate(others):
            part = slice(self.first[j], self.first[j + 1])
            shared = np.minimum(self.dense[self.at[part]], self.weight[part])
            common = float(shared.sum())
            out[k] = common >= LEAST * (self.total[i] + self.total[j] - common) - 1e-6 * self.total[i]
        self.dense[self.at[own]] = 0
        return out


def _texts(table: pa.Table) -> tuple[list[int], list[str], list[int]]:
    """Distinct nodes of a block with their texts and the rows they stand in; of repeated ids the smallest text."""
    nodes, texts = table["node"].to_pylist(), table["text"].to_pylist()
    best: dict[int, int] = {}
    for i, (node, text) in enumerate(zip(nodes, texts)):
        if node not in best or text < texts[best[node]]:
            best[node] = i
    rows = sorted(best.values())
    return [nodes[i] for i in rows], [texts[i] for i in rows], rows


LINK_SCHEMA = "a long, b long"


def _links(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def central_links(members: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """Verified links between the nodes of each bucket and its most central nodes."""
    central = members.groupBy("node").agg(F.sum("n").alias("weight"))
    order = Window.partitionBy("band", "key").orderBy(F.col("weight").desc(), "node")
    leaders = (members.select("band", "key", "node", "n").join(central, "node").withColumn("r", F.row_number().over(order))
               .filter(F.col("r") <= CENTRAL).select("band", "key", "n", F.col("node").alias("leader")))
    few = staged(leaders.groupBy("band", "key").agg(F.collect_list("leader").alias("leaders"), F.first("n").alias("n")), "leaders")
    met = join_by_size(members.select("band", "key", "node"), few, ["band", "key"], "n")
    pairs = (met.select("node", F.explode("leaders").alias("leader")).filter("node <> leader")
             .select(F.greatest("node", "leader").alias("x"), F.least("node", "leader").alias("y"),
                     "node", "leader").groupBy("x", "y").agg(F.min(F.struct("leader", "node")).alias("p")).select("p.*"))
    pairs = staged(pairs, "pairs")
    size = staged(pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("n")), "leaders")
    pairs = staged(join_by_size(pairs, size, "leader", "n").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / PAIR_BLOCK))).select("leader", "block", "node"), "pairs")
    nodes = pairs.unionByName(pairs.select("leader", "block", F.col("leader").alias("node")).distinct())
    group = nodes.hint("merge").join(texts, "node").select("leader", "block", "node", "text")

    def verify(table: pa.Table) -> pa.Table:
        nodes, found, _ = _texts(table)
        leader = table["leader"][0].as_py()
        i = nodes.index(leader)
        others = np.array([j for j in range(len(nodes)) if j != i], np.int64)
        hit = Vectors(found, idf.value).similar(i, others)
        return _links([(nodes[j], leader) for j in others[hit]])

    return by_group(group, ["leader", "block"], verify, LINK_SCHEMA)


def _open_pairs(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js) of a block: pairs of different components that agree in enough samples, each pair in its first common bucket."""
    bands = np.array(table["bands"].to_pylist(), np.int64).reshape(len(table), -1).astype(U)
    samples = np.concatenate([bands >> U(32), bands & U(0xFFFFFFFF)], 1).astype(np.uint32)
    labels, side = table["label"].to_numpy(), table["side"].to_numpy()
    band, lo, hi = (table[c][0].as_py() for c in ("band", "i", "j"))
    names, counts = np.unique(labels, return_counts=True)
    largest = labels == names[np.argmax(counts)]
    for i in np.flatnonzero(~largest if lo == hi else side == lo):
        ok = labels != labels[i]
        if lo == hi:
            ok &= largest | (np.arange(len(table)) > i)
        else:
            ok &= side == hi
        js = np.flatnonzero(ok)
        js = js[(samples[js] == samples[i]).sum(1) >= AGREE]
        js = js[~(bands[js, :band] == bands[i, :band]).any(1)]
        if len(js):
            yield int(i), js


def _worth(table: pa.Table) -> pa.Table:
    """The nodes of a block that have an open pair in it."""
    need = np.zeros(len(table), bool)
    for i, js in _open_pairs(table):
        need[i] = need[js] = True
    return table.filter(pa.array(need))


def remaining_links(members: DataFrame, nodes: DataFrame, labels: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """Verified links between nodes of different components within a bucket.

    In a bucket over ``BLOCK_NODES`` the nodes of its largest component are cut
    into sides that meet the others' sides only, so rows grow with the others
    times the number of sides.
    """
    bucket = ["band", "key"]
    known = members.select(*bucket, "node").join(labels, "node", "left").select(
        *bucket, "node", F.coalesce("label", "node").alias("label"))
    parts = known.groupBy(*bucket, "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy(*bucket).agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("labels"))
    mixed = staged(mixed.filter("labels > 1").select(*bucket, "size", F.col("m.n").alias("most"), F.col("m.label").alias("major")), "mixed")
    rows = join_by_size(known, mixed, bucket, "size")
    small = F.col("size") <= BLOCK_NODES
    others = F.when(small, 1).otherwise(F.ceil((F.col("size") - F.col("most")) / BLOCK_NODES))
    majors = F.when(small, 0).otherwise(F.ceil(F.col("most") / BLOCK_NODES))
    is_major = ~small & (F.col("label") == F.col("major"))
    side = F.when(is_major, others + F.pmod(F.xxhash64("node"), F.greatest(majors, F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), others))
    meets = F.sequence(F.lit(0).cast("long"), F.when(is_major, others - 1).otherwise(others + majors - 1))
    rows = (rows.withColumn("side", side.cast("long")).withColumn("other", F.explode(meets))
            .select(*bucket, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "label")
            .join(nodes, "node").select(*bucket, "i", "j", "side", "node", "label", "bands"))
    block = [*bucket, "i", "j"]
    worth = staged(by_group(rows, block, _worth, rows.schema), "open")
    group = worth.hint("merge").join(texts, "node").select(*worth.columns, "text")

    def verify(table: pa.Table) -> pa.Table:
        nodes, found, rows = _texts(table)
        table = table.take(pa.array(rows))
        vectors = Vectors(found, idf.value)
        names = table["label"].to_pylist()
        root = {label: label for label in names}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        links = []
        for i, js in _open_pairs(table):
            for j in js:
                if find(names[j]) != find(names[i]) and vectors.similar(i, np.array([j]))[0]:
                    root[find(names[j])] = find(names[i])
                    links.append((nodes[i], nodes[j]))
        return _links(links)

    return by_group(group, block, verify, LINK_SCHEMA)


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id): one row per distinct document id, and one per row with a null id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs))
    signed = staged(signatures(docs, idf), "signatures")
    nodes = staged(signed.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"),
                                                F.count(F.lit(1)).alias("copies")), "nodes")
    spread = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    full = staged(spread.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "full")
    members = staged(join_by_size(spread, full, ["band", "key"], "n"), "members")
    texts = staged(docs.withColumnRenamed("doc_id", "node").join(
        members.select("node").distinct().hint("merge"), "node", "left_semi"), "texts")
    first = staged(central_links(members, texts, idf), "links")
    many = nodes.filter("copies > 1").select("digest", "node", "copies")
    copies = join_by_size(signed.select("doc_id", "digest"), many, "digest", "copies").filter("doc_id <> node").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b"))
    labels = connected_components(first)
    rest = staged(remaining_links(members, nodes.select("node", "bands"), labels, texts, idf), "links")
    final = connected_components(first.unionByName(rest).unionByName(copies))
    idf.destroy()  # all that reads it is written
    out = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().join(
        final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    unnamed = docs.filter("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return out.select("doc_id", F.coalesce("label", "doc_id").alias("class_id")).unionByName(unnamed)


def representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one of least ``doc_id``.

    Of rows with equal ``doc_id`` the one of least text hash stays (they share
    the partitioning of the join, so this adds no shuffle); null ids all stay.
    """
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64("text").alias("h"))
    kept = classes(docs).filter("doc_id = class_id").select(F.col("doc_id").alias("id"))
    order = Window.partitionBy("id").orderBy("h")
    once = rows.join(kept, "id", "left_semi").withColumn("r", F.row_number().over(order)).filter("r = 1")
    return once.select("row.*").unionByName(rows.filter("id IS NULL").select("row.*"))
