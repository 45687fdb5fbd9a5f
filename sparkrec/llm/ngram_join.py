"""N-gram Jaccard join (12): token-combination prefixes, then exact verification.

A document's set holds its distinct ``WORDS``-word shingles.  Two documents link
when ``100 * intersection >= PERCENT * union``.

1. Frequencies of shingles are counted over all documents in 2**COUNTER_BITS
   hashed counters.  They set one global order, rare first (only the order
   depends on them, never the result), and three classes of shingles.
2. A set of n shingles may lack ``(100 - PERCENT) * n // 100`` of them in a linked
   set.  Its prefix takes shingles in order until more than that many removals
   are needed to destroy all of its signatures: a rare shingle is a signature
   alone; frequent ones are hashed into groups and each pair (very frequent:
   each triple) of a group is one, so a group of g resists ``g - k + 1`` removals and
   the prefix is extended as needed.  Linked sets share at least one signature.
   Group numbers depend on the size's power of two; sets that may link
   into the next power are indexed under both.
3. Equal sets are one node.  Signatures are range-sorted, so that equal ones
   stand together; those of equal node lists are one group.
4. All nodes of a group are first compared with its least node, and links merge
   into components.
5. Groups that still hold different components are compared completely, but
   for the nodes of their largest component among themselves.  Blocks have at
   most ``BLOCK_NODES`` nodes a side and emit links, never pairs.

Before texts are compared, parity sketches are: those of two linked sets differ
in at most as many bits as the sets do in shingles, which leaves few pairs.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; shingles are 64-bit hashes
of their words' 64-bit hashes (xxh3), sets are named by 128 bits over them.

Defined cases: a null or empty text, or one of blanks, has an empty set and no
links; fewer than ``WORDS`` words are one shingle; rows of equal or null ``doc_id``
are rows of their own and link by text alone; a component without any id has a
null id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import by_group, join_by_size, pieces, slices, staged
from sparkrec.llm.components import connected_components
from sparkrec.llm.shingles import U, mix
from sparkrec.llm.urls import build_filter, might_contain, words_for

WORDS = 4
PERCENT = 85
COUNTER_BITS = 22  # the driver and each worker hold one byte a counter
SLICES = 64
BLOCK_BYTES = 1 << 20
LIST_NODES = 256  # signatures of more nodes are groups of their own
COMBINED_FROM = 6  # smallest size class (log2) whose frequent shingles are combined
FREQUENT, VERY_FREQUENT = 16, 256  # times the mean counter, and shingles besides
BLOCK_NODES = 4096
PAIR_BLOCK = 256
_SALT = mix(np.arange(1, 300, dtype=U) * U(0xD6E8FEB86659FD93))


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U)


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[first:last]``: of up to 16 bytes as two machine words, of longer ones by xxh3."""
    size = last - first
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.ndarray((len(data) + 8,), "<u8", padded, 0, (1,))
    low = words[first] & MASKS[np.minimum(size, 8)]
    high = words[np.minimum(first + 8, len(data))] & MASKS[np.clip(size - 8, 0, 8)]
    out = mix(mix(low + _SALT[260]) ^ (high + size.astype(U) * _SALT[261]))
    for i in np.flatnonzero(size > 16):
        out[i] = xxhash.xxh3_64_intdigest(data[first[i]:last[i]].tobytes(), 1)
    return out


def block_shingles(texts: list[str | None], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles in order, where those of each text begin and the number of all); repeats included."""
    raw = [(t or "").encode().lower() for t in texts]  # of bytes: A-Z only
    data = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    word = ~BLANK[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    hashes = word_hashes(data, start, end)
    lengths = np.array([len(r) for r in raw], np.int64)
    at = np.searchsorted(start, np.append(0, np.cumsum(lengths + 1)) + 1)
    n_words = np.diff(at)
    per = np.where(n_words > 0, np.maximum(n_words - size + 1, 1), 0)
    ends = np.cumsum(per)
    text = np.repeat(np.arange(len(per)), per)
    place = at[:-1][text] + np.arange(len(text)) - (ends - per)[text]
    held = np.minimum(n_words, size)[text]
    keys = held.astype(U)
    for j in range(size):
        more = mix((keys ^ hashes[np.minimum(place + j, len(hashes) - 1)]) + _SALT[j]) if len(text) else keys
        keys = np.where(held > j, more, keys)
    return keys, np.append(0, ends)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted hashes of the distinct shingles of each whole text."""
    for a, b in slices([len(t or "") for t in texts], BLOCK_BYTES):
        keys, first = block_shingles(texts[a:b])
        for x, y in zip(first, first[1:]):
            yield np.unique(keys[x:y])


def shingle_set(text: str | None) -> np.ndarray:
    return next(shingle_sets([text]))


def counter(keys: np.ndarray) -> np.ndarray:
    return (keys >> U(64 - COUNTER_BITS)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task a row for each slice: counters up to 255 in a byte each, and the places and counts of larger ones.

    Repeats within a text count too: the order is none the worse for it.
    """
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    for batch in pieces(batches):
        texts = batch.column(0).to_pylist()
        for a, b in slices([len(t or "") for t in texts], BLOCK_BYTES):
            np.add.at(counts, counter(block_shingles(texts[a:b])[0]), 1)
    width = len(counts) // SLICES
    rows = [counts[s:s + width] for s in range(0, len(counts), width)]
    large = [np.flatnonzero(r > 255) for r in rows]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(SLICES, dtype=np.int32)),
         pa.array([np.where(r > 255, 0, r).astype(np.uint8).tobytes() for r in rows], pa.binary()),
         pa.array([x.tolist() for x in large], pa.list_(pa.int32())),
         pa.array([r[x].tolist() for r, x in zip(rows, large)], pa.list_(pa.int64()))], ["slice", "counts", "places", "larger"])


def _sum_slice(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((1 << COUNTER_BITS) // SLICES, np.int64)
    for batch in groups:
        for counts, places, larger in zip(*(batch.column(n) for n in ("counts", "places", "larger"))):
            total += np.frombuffer(counts.as_buffer(), np.uint8)
            total[places.values.to_numpy()] += larger.values.to_numpy()
    level = np.where(total > 0, 1 + np.floor(4 * np.log2(np.maximum(total, 1))), 0).astype(np.uint8)  # a quarter octave each
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([level.tobytes()], pa.binary()),
                                      pa.array([int(total.sum())], pa.int64())], ["slice", "levels", "total"])


def frequency_levels(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(level of each counter, tokens a signature takes at each level), from every document."""
    rows = docs.select("text").mapInArrow(_frequencies, "slice int, counts binary, places array<int>, larger array<long>")
    found = rows.groupBy("slice").applyInArrow(_sum_slice, "slice int, levels binary, total long").orderBy("slice").collect()
    levels = np.frombuffer(b"".join(bytes(r["levels"]) for r in found) or bytes(1 << COUNTER_BITS), np.uint8)
    mean = sum(r["total"] for r in found) / len(levels)
    size = 2.0 ** ((np.arange(256) - 1) / 4)
    return levels, 1 + (size > FREQUENT * (1 + mean)).astype(np.int8) + (size > VERY_FREQUENT * (1 + mean)).astype(np.int8)


def allowed(n: int) -> int:
    """How many shingles of a set of ``n`` a linked set may lack."""
    return (100 - PERCENT) * n // 100


def _combined(keys: np.ndarray, take: np.ndarray, groups: int, need: int) -> np.ndarray:
    """Signatures of ordered ``keys`` of which ``take`` make one, up to the first prefix that resists ``need - 1`` removals."""
    group = np.where(take == 1, np.arange(len(keys)), len(keys) + take * groups + (mix(keys + _SALT[250]) % U(groups)).astype(np.int64))
    order = np.argsort(group, kind="stable")
    start = np.flatnonzero(np.diff(group[order], prepend=-1))
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys)) - np.repeat(start, np.diff(np.append(start, len(keys))))
    end = int(np.searchsorted(np.cumsum(rank >= take - 1), need)) + 1
    order = order[order < end]
    keys, rank, take = keys[order], rank[order], take[order]  # by group, each in the global order
    out = [mix(keys[take == 1] + _SALT[251])]
    for far in range(1, int(rank.max(initial=0)) + 1):
        at = np.flatnonzero((take == 2) & (rank >= far))
        out.append(mix(mix(keys[at - far] + _SALT[252]) ^ keys[at]))
        at = np.flatnonzero((take == 3) & (rank >= far))
        for near in range(1, far):
            out.append(mix(mix(mix(keys[at - far] + _SALT[253]) ^ keys[at - near]) ^ keys[at]))
    return np.concatenate(out)


def signatures(keys: np.ndarray, levels: np.ndarray, takes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(size class, signatures) of a set, for its own class and, if it may link into it, the next.

    The class is the lowest six bits of each signature.
    """
    n = len(keys)
    if not n:
        return []
    own = n.bit_length() - 1
    level = levels[counter(keys)]
    keys = keys[np.argsort((level.astype(U) << U(56)) | (keys >> U(8)), kind="stable")]
    take = takes[np.sort(level)]
    need = allowed(n) + 1
    out = []
    for kind in [own, own + 1] if 100 * n >= PERCENT << own + 1 else [own]:
        if kind < COMBINED_FROM or take[need - 1] == 1:
            got = mix(keys[:need] + _SALT[251])
        else:
            got = _combined(keys, take.astype(np.int64), max((16 << kind) // 100, 1), need)
        out.append((kind, mix(got ^ _SALT[kind]) & ~U(63) | U(kind)))
    return out


def sketch(keys: np.ndarray, kind: int) -> bytes:
    """Parity of the set's shingles in each of ``max(64, 2 ** (kind + 1))`` hash cells."""
    cells = max(64, 2 << kind)
    at = (mix(keys + _SALT[254]) & U(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8)).tobytes()


SIGNED = "doc_id long, h long, n long, digest binary, node long, entries array<struct<kind:int,signatures:array<long>,sketch:binary>>"


def sign(docs: DataFrame, model, salt: int = 0) -> DataFrame:
    """``SIGNED`` for every row of (doc_id, text, h); ``model`` broadcasts what ``frequency_levels`` returns.

    ``node`` is 64 bits of the set's digest.  A set that a task has seen before
    gets no entries again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, takes = model.value
        seen: set[int] = set()
        for batch in pieces(batches, 500):
            n, digests, nodes, per, kinds, found, sketches = [], [], [], [], [], [], []
            for keys in shingle_sets(batch.column(1).to_pylist()):
                digest = hashlib.blake2b(keys.tobytes(), digest_size=16).digest()
                node = xxhash.xxh3_64_intdigest(digest, salt) - (1 << 63)
                n.append(len(keys))
                digests.append(digest)
                nodes.append(node)
                entries = [] if node in seen else signatures(keys, levels, takes)
                seen.add(node)
                per.append(len(entries))
                for kind, got in entries:
                    kinds.append(kind)
                    found.append(got.view(np.int64))
                    sketches.append(sketch(keys, kind))
            flat = np.concatenate([np.zeros(0, np.int64), *found])
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            entry = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(flat)), pa.array(sketches, pa.binary())],
                ["kind", "signatures", "sketch"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(nodes, pa.int64()),
                 pa.ListArray.from_arrays(np.cumsum([0, *per]).astype(np.int32), entry)],
                ["doc_id", "h", "n", "digest", "node", "entries"])

    return docs.select("doc_id", "text", "h").mapInArrow(run, SIGNED)


def _lists(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted (sig, node) rows to the node lists of the signatures that several nodes share.

    The first and the last signature of a task may go on in others, and lists
    over ``most`` are not held: these come out node by node, with the signature.
    """
    sigs = nodes = np.zeros(0, np.int64)
    first, long = True, None
    for batch in batches:
        sigs = np.concatenate([sigs, batch.column("sig").to_numpy()])
        nodes = np.concatenate([nodes, batch.column("node").to_numpy()])
        if not len(sigs):
            continue
        new = np.append(True, (sigs[1:] != sigs[:-1]) | (nodes[1:] != nodes[:-1]))
        sigs, nodes = sigs[new], nodes[new]
        start = np.flatnonzero(np.append(True, sigs[1:] != sigs[:-1]))
        size = np.diff(np.append(start, len(sigs)))
        single = size > most
        if len(start) > 1:
            single[0] |= first
            first = False
        if long is not None:
            single |= sigs[start] == long
        tail = start[-1]
        if len(sigs) - tail > most:  # goes on, or has been given out in part
            long, tail = int(sigs[-1]), len(sigs) - 1
        whole = np.arange(len(start)) < len(start) - 1
        alone = np.repeat(single & whole, size)
        alone[start[-1]:tail] = True
        runs = [nodes[a:a + n] for a, n in zip(start[whole & ~single & (size > 1)], size[whole & ~single & (size > 1)])]
        kinds = sigs[start[whole & ~single & (size > 1)]]
        yield _list_batch(sigs[alone], nodes[alone], kinds, runs)
        sigs, nodes = sigs[tail:], nodes[tail:]
    yield _list_batch(sigs, nodes, sigs[:0], [])


def _list_batch(sigs: np.ndarray, nodes: np.ndarray, of_lists: np.ndarray, lists: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate([nodes, *lists]).astype(np.int64)
    ends = np.cumsum([0, *[1] * len(nodes), *map(len, lists)]).astype(np.int32)
    names = pa.array(np.append(sigs, np.zeros(len(lists), np.int64)), mask=np.arange(len(sigs) + len(lists)) >= len(sigs))
    return pa.RecordBatch.from_arrays([pa.array((np.append(sigs, of_lists) & 63).astype(np.int32)), names, pa.ListArray.from_arrays(ends, pa.array(flat))],
                                      ["kind", "sig", "nodes"])


def shared_groups(signed: DataFrame, list_nodes: int = LIST_NODES) -> DataFrame:
    """(sig, kind, node, size, leader): the nodes of every group of two or more nodes that share a signature.

    Signatures of equal node lists are one group, named by a hash of the list.
    Rows are cut by range, so a hot signature is spread over tasks.
    """
    spread = signed.select("node", F.explode("entries").alias("e")).select("node", F.explode("e.signatures").alias("sig"))
    ordered = spread.repartitionByRange("sig", "node").sortWithinPartitions("sig", "node")
    found = staged(ordered.mapInArrow(partial(_lists, most=list_nodes), "kind int, sig long, nodes array<long>"), "lists")
    lists = found.filter("sig IS NULL").select("kind", "nodes").distinct().withColumn("sig", F.xxhash64("kind", "nodes"))
    rows = lists.select("sig", "kind", F.explode("nodes").alias("node")).unionByName(
        found.filter("sig IS NOT NULL").select("sig", "kind", F.col("nodes")[0].alias("node"))).distinct()
    rows = staged(rows, "rows")
    sizes = staged(rows.groupBy("sig", "kind").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader")).filter("size > 1"), "sizes")
    return join_by_size(rows, sizes, ["sig", "kind"], "size")


class Sets:
    """The shingle sets of the texts of one block, as numbers."""

    def __init__(self, texts: list[str]):
        sets = list(shingle_sets(texts))
        self.size = np.array([len(s) for s in sets], np.int64)
        self.first = np.append(0, np.cumsum(self.size))
        names, self.at = np.unique(np.concatenate(sets), return_inverse=True)
        self.held = np.zeros(len(names), bool)

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` link to text ``i``."""
        own = self.at[self.first[i]:self.first[i + 1]]
        self.held[own] = True
        common = np.array([np.count_nonzero(self.held[self.at[self.first[j]:self.first[j + 1]]]) for j in others], np.int64)
        self.held[own] = False
        return 100 * common >= PERCENT * (self.size[i] + self.size[others] - common)


LINKS = "a long, b long"


def _links(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _allowed_pairs(bits: np.ndarray, sizes: np.ndarray, i: int, js: np.ndarray) -> np.ndarray:
    """Those of ``js`` whose sizes and sketches allow a link with ``i``."""
    js = js[(100 * sizes[js] >= PERCENT * sizes[i]) & (100 * sizes[i] >= PERCENT * sizes[js])]
    apart = np.bitwise_count(bits[js] ^ bits[i]).sum(1, dtype=np.int64)
    return js[(100 + PERCENT) * apart <= (100 - PERCENT) * (sizes[i] + sizes[js])]


def _sketches(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(table), -1)


def _star_worth(table: pa.Table) -> pa.Table:
    """A block's leader and those of its nodes that may link to it; no rows if there are none."""
    nodes = table["node"].to_numpy()
    at = int(np.flatnonzero(nodes == table["leader"][0].as_py())[0])
    js = _allowed_pairs(_sketches(table), table["n"].to_numpy(), at, np.flatnonzero(nodes != nodes[at]))
    return table.take(pa.array([at, *js.tolist()] if len(js) else [], pa.int64()))


def _verify_star(table: pa.Table) -> pa.Table:
    """Links of a block between its leader and the others."""
    rows = dict(zip(table["node"].to_pylist(), table["text"].to_pylist()))
    leader = table["leader"][0].as_py()
    nodes = [leader, *(n for n in rows if n != leader)]
    hit = Sets([rows[n] for n in nodes]).linked(0, np.arange(1, len(nodes)))
    return _links([(n, leader) for n, h in zip(nodes[1:], hit) if h])


def star_blocks(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """(leader, block, kind, node, n, sketch): leaders with those nodes of their groups that may link to them."""
    pairs = staged(members.filter("node <> leader").select("leader", "kind", "node").distinct(), "pairs")
    size = staged(pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("size")), "leaders")
    blocks = staged(join_by_size(pairs, size, "leader", "size").select(
        "leader", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / PAIR_BLOCK)).alias("block"), "kind", "node"), "blocks")
    nodes = blocks.unionByName(blocks.select("leader", "block", "kind", F.col("leader").alias("node")).distinct())
    rows = nodes.join(sketches.hint("merge"), ["node", "kind"]).select("leader", "block", "kind", "node", "n", "sketch")
    return by_group(rows, ["leader", "block", "kind"], _star_worth, rows.schema).drop("n", "sketch")


def with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    return rows.join(texts.hint("merge"), "node")


def _open_pairs(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js) of a block: pairs of different components that may link, each pair once."""
    labels, sizes, side = (table[c].to_numpy() for c in ("label", "n", "side"))
    bits = _sketches(table)
    lo, hi = table["i"][0].as_py(), table["j"][0].as_py()
    names, counts = np.unique(labels, return_counts=True)
    largest = labels == names[np.argmax(counts)]
    for i in np.flatnonzero(~largest if lo == hi else side == lo):
        ok = labels != labels[i]
        ok &= largest | (np.arange(len(table)) > i) if lo == hi else side == hi
        js = _allowed_pairs(bits, sizes, i, np.flatnonzero(ok))
        if len(js):
            yield int(i), js


def _worth(table: pa.Table) -> pa.Table:
    """The nodes of a block that have an open pair in it."""
    need = np.zeros(len(table), bool)
    for i, js in _open_pairs(table):
        need[i] = need[js] = True
    return table.filter(pa.array(need))


def _verify_block(table: pa.Table) -> pa.Table:
    """Links that join components of a block; pairs that are joined already are passed over."""
    rows = {node: k for k, node in enumerate(table["node"].to_pylist())}
    table = table.take(pa.array(sorted(rows.values())))
    nodes, labels = table["node"].to_pylist(), table["label"].to_pylist()
    sets = Sets(table["text"].to_pylist())
    root = {label: label for label in labels}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, js in _open_pairs(table):
        for j in js:
            if find(labels[i]) != find(labels[j]) and sets.linked(i, np.array([j]))[0]:
                root[find(labels[j])] = find(labels[i])
                links.append((nodes[i], nodes[j]))
    return _links(links)


def remaining_blocks(members: DataFrame, sketches: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of blocks that hold pairs of different components which may link.

    A group over ``BLOCK_NODES`` is cut into sides; the nodes of its largest
    component are sides of their own that meet the others' sides only.
    """
    group = ["sig", "kind"]
    known = members.select(*group, "node").join(labels.hint("merge"), "node", "left").select(
        *group, "node", F.coalesce("label", "node").alias("label"))
    parts = known.groupBy(*group, "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy(*group).agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("labels"))
    mixed = staged(mixed.filter("labels > 1").select(*group, "size", F.col("m.n").alias("most"), F.col("m.label").alias("major")), "mixed")
    rows = join_by_size(known, mixed, group, "size")
    small = F.col("size") <= BLOCK_NODES
    others = F.when(small, 1).otherwise(F.ceil((F.col("size") - F.col("most")) / BLOCK_NODES))
    majors = F.when(small, 0).otherwise(F.ceil(F.col("most") / BLOCK_NODES))
    is_major = ~small & (F.col("label") == F.col("major"))
    side = F.when(is_major, others + F.pmod(F.xxhash64("node"), F.greatest(majors, F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), others))
    meets = F.sequence(F.lit(0).cast("long"), F.when(is_major, others - 1).otherwise(others + majors - 1))
    blocks = (rows.withColumn("side", side.cast("long")).withColumn("other", F.explode(meets))
              .select(*group, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "label"))
    full = blocks.join(sketches.hint("merge"), ["node", "kind"]).select(*group, "i", "j", "side", "node", "label", "n", "sketch")
    return by_group(full, [*group, "i", "j"], _worth, full.schema)


def components(docs: DataFrame, list_nodes: int = LIST_NODES) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumn("h", F.xxhash64("text"))
    model = spark.sparkContext.broadcast(frequency_levels(docs))
    salt = 0
    while True:
        signed = staged(sign(docs, model, salt), "signed")
        nodes = staged(signed.filter("n > 0").groupBy("node").agg(
            F.min("digest").alias("digest"), F.max("digest").alias("other"), F.min(F.struct("doc_id", "h")).alias("first"),
            F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "nodes")
        if nodes.filter("digest <> other").isEmpty():
            break
        salt += 1  # two sets had one 64-bit name
    model.destroy()
    members = staged(shared_groups(signed, list_nodes), "members")
    wanted = members.select("node").distinct()
    each = signed.select("node", "n", F.explode("entries").alias("e")).select("node", "n", "e.kind", "e.sketch")
    sketches = staged(each.join(wanted.hint("merge"), "node", "left_semi").groupBy("node", "kind").agg(
        F.min("n").alias("n"), F.min("sketch").alias("sketch")), "sketches")
    stars = staged(star_blocks(members, sketches), "stars")
    texts = staged(texts_of(docs, nodes, stars.select("node").distinct()), "texts")
    first = staged(by_group(with_texts(stars, texts), ["leader", "block", "kind"], _verify_star, LINKS), "links")
    labels = connected_components(first)
    opened = staged(remaining_blocks(members, sketches, labels), "open")
    texts = staged(texts_of(docs, nodes, opened.select("node").distinct()), "texts")
    rest = staged(by_group(with_texts(opened, texts), ["sig", "kind", "i", "j"], _verify_block, LINKS), "links")
    final = connected_components(first.unionByName(rest))
    named = staged(nodes.join(final.hint("merge"), "node", "left").select("node", "copies", "least", F.coalesce("label", "node").alias("label")), "named")
    least = staged(named.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("nodes")), "least")
    ids = staged(join_by_size(named, least, "label", "nodes").select("node", "copies", "component_id"), "ids")
    some = join_by_size(signed.filter("n > 0").select("doc_id", "n", "node"), ids, "node", "copies")
    none = signed.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return some.select("doc_id", "n", "component_id").unionByName(none).withColumnRenamed("n", "n_shingles")


def texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes: the text of one document of each.

    A Bloom filter of the wanted texts' hashes (of bounded size) goes over the
    documents first, so that other texts are not shuffled.
    """
    at = staged(nodes.join(wanted.hint("merge"), "node", "left_semi").select(
        "node", F.col("first.doc_id").alias("d"), F.col("first.h").alias("k")), "wanted")
    n_words = words_for(at.count())
    passed = docs.withColumn("words", build_filter(at.select(F.col("k").alias("key")), n_words).scalar()).filter(
        might_contain(F.col("words"), F.col("h"), n_words)).drop("words")
    return (passed.join(at.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k")))
            .groupBy("node").agg(F.min("text").alias("text")))
