"""Cross-tokenizer alignment (13): merge-path partitioning of two token streams over the same bytes.

Text is encoded by a byte-level tokenizers file (A, of a blank and the text)
and by a sentencepiece model (B, which adds the blank).  Both cut the same bytes, so each
token ends at a byte offset, and two ascending lists of ends describe a block
of documents.

* Diagonal binary searches cut the merge of both lists into pieces of ``WORK``
  steps each, independent of each other and of where documents begin.
* Each piece emits the overlapping token pairs (links) whose later start lies
  in it, and the offsets where A and B both end.
* Those offsets, put together over the pieces, cut the stream into groups: the
  smallest runs of A and of B tokens that cover the same bytes.

Pair counts over the corpus: pairs that make up over 1 of ``HEAVY`` links (so
at most ``HEAVY`` pairs) are broadcast and looked up in place, the others are
joined; no join key holds more than 1 of ``HEAVY`` links.

Defined cases: a null or empty text, and one whose A or B bytes differ from a
blank and the text (U+2581 in it), has no tokens; special-token strings inside
a text are plain text; null and repeated ``doc_id`` rows are rows of their own;
an empty table gives no rows; columns named like the results stay apart in ``row``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import pieces, slices, staged
from sparkrec.llm.encode import Encoder, Memo, distinct_tokens, encoder, gather

WORK = 1 << 16
HEAVY = 1 << 16
BLOCK_CHARS = 1 << 21
BITS = 20  # of a token id inside a pair key
PIECE_SPACE = "▁".encode()


def byte_level_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass
class TokenBytes:
    """The bytes of every id of a vocabulary, one after the other."""

    data: np.ndarray
    first: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> TokenBytes:
        size = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        end = np.cumsum(size)
        return self.data[np.repeat(self.first[ids] - (end - size), size) + np.arange(end[-1] if len(ids) else 0)]


class Pieces:
    """A sentencepiece model whose pieces hold no blank after another character, so blanks start independent units."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a piece of this model spans a blank")
        self.bytes = TokenBytes.of([bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.encode().replace(PIECE_SPACE, b" ")
                                    for i, n in enumerate(names)])
        self.memo = Memo(self._fresh)

    def _fresh(self, units: list[bytes]) -> list[bytes]:
        """Ids of units that begin with a blank (the model adds the first one); blanks alone are read behind a word."""
        texts = [u.decode() for u in units]
        blank = [not t.strip(" ") for t in texts]
        found = self.model.encode(["x" + t if b else t[1:] for t, b in zip(texts, blank)], num_threads=1)
        behind = len(self.model.encode("x", num_threads=1))
        return [np.array(ids[behind:] if b else ids, "<u4").tobytes() for ids, b in zip(found, blank)]

    def encode_all(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of each text and the number of all) of texts that lie one after the other in ``data``."""
        cut = np.zeros(len(data), bool)
        blank = data == 32
        cut[1:] = blank[1:] & ~blank[:-1]
        cut[starts] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(data))
        at, kinds = distinct_tokens(data, first, last)
        ids, total = gather(self.memo.look_up([data[a:b].tobytes() for a, b in zip(first[at], last[at])]), kinds)
        return ids, np.append(np.append(0, total)[np.searchsorted(first, starts)], len(ids))


_TOKENIZERS: dict[tuple[str, str], tuple[Encoder, TokenBytes, Pieces]] = {}


def tokenizers_of(path_a: str, path_b: str) -> tuple[Encoder, TokenBytes, Pieces]:
    """One pair of tokenizers per Python worker."""
    if (path_a, path_b) not in _TOKENIZERS:
        enc = encoder(path_a)
        alphabet = byte_level_alphabet()
        names = [enc.tokenizer.id_to_token(i) for i in range(enc.vocabulary)]
        tokens = [bytes(alphabet[c] for c in n) if all(c in alphabet for c in n) else n.encode() for n in names]
        both = enc, TokenBytes.of(tokens), Pieces(path_b)
        if max(len(both[1].size), len(both[2].bytes.size)) > 1 << BITS:
            raise ValueError("vocabulary too large for a pair key")
        _TOKENIZERS[path_a, path_b] = both
    return _TOKENIZERS[path_a, path_b]


def diagonal(a: np.ndarray, b: np.ndarray, steps: int) -> int:
    """How many of the first ``steps`` of the merge of ``a`` and ``b`` (ties: a first) come from ``a``."""
    lo, hi = max(0, steps - len(b)), min(steps, len(a))
    while lo < hi:
        mid = (lo + hi) // 2
        if a[mid] <= b[steps - 1 - mid]:
            lo = mid + 1
        else:
            hi = mid
    return lo


def merge_piece(a: np.ndarray, b: np.ndarray, lo: tuple[int, int], hi: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """Links (index in a, index in b) and common ends (the same) of the merge steps from ``lo`` to ``hi``."""
    (i0, j0), (i1, j1) = lo, hi
    of_a = np.arange(i0, i1)
    met = j0 + np.searchsorted(b[j0:j1], a[i0:i1])
    of_b = np.arange(j0, j1)
    back = max(i0 - 1, 0)  # an equal end of a comes first, perhaps in the piece before
    over = back + np.searchsorted(a[back:i1], b[j0:j1])
    tie = np.zeros(len(of_b), bool)
    inside = over < i1
    tie[inside] = a[over[inside]] == b[j0:j1][inside]
    return (np.concatenate([of_a, over[~tie]]), np.concatenate([met, of_b[~tie]]), over[tie], of_b[tie])


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, ...]:
    """All links and common ends of two ascending lists with an equal last value, by pieces of equal work."""
    total = len(a) + len(b)
    cuts = [(i := diagonal(a, b, d), d - i) for d in [*range(0, total, work), total]]
    found = [merge_piece(a, b, lo, hi) for lo, hi in zip(cuts, cuts[1:])]
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(4))


@dataclass
class Aligned:
    """One block of texts: ids of both sides, where each text begins in them, links and group ends as indices."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray

    def document(self, kind: str) -> np.ndarray:
        """The text of each link or group, by its A token."""
        at = self.link_a if kind == "links" else self.end_a
        return np.searchsorted(self.first_a, at, "right") - 1


def _subset(ids: np.ndarray, first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the ids of the texts that are not kept."""
    n = np.diff(first)
    return ids[np.repeat(keep, n)], np.append(0, np.cumsum(np.where(keep, n, 0)))


def align_block(texts: list[str], path_a: str, path_b: str, work: int = WORK) -> Aligned:
    enc, bytes_a, pieces_b = tokenizers_of(path_a, path_b)
    full = np.array([bool(t) for t in texts], bool)
    spaced = [" " + t for t in texts if t]
    raw = [t.encode() for t in spaced]
    size = np.array([len(r) for r in raw], np.int64)
    start = np.cumsum(size) - size
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids_a = enc.encode_all(spaced)
    a = np.frombuffer(b"".join(ids_a), "<u4")
    first_a = np.cumsum([0, *(len(x) // 4 for x in ids_a)])
    b, first_b = pieces_b.encode_all(data, start)
    keep = np.ones(len(raw), bool)
    for ids, first, table in ((a, first_a, bytes_a), (b, first_b, pieces_b.bytes)):
        got = table.joined(ids)
        if not np.array_equal(got, data):
            ends = np.append(0, np.cumsum(table.size[ids]))[first]
            keep &= [np.array_equal(got[s:e], data[x:x + n]) for s, e, x, n in zip(ends, ends[1:], start, size)]
    a, first_a = _subset(a, first_a, keep)
    b, first_b = _subset(b, first_b, keep)
    links = merge_path(np.cumsum(bytes_a.size[a]), np.cumsum(pieces_b.bytes.size[b]), work)
    at = np.append(0, np.cumsum(full))
    return Aligned(a, b, first_a[at], first_b[at], *links)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.array(values, kind))


def _map(docs: DataFrame, keep: list[str], paths: tuple[str, str], fields: str,
         build: Callable[[Aligned, int], list[pa.Array]]) -> DataFrame:
    """``row`` (the columns ``keep``) and what ``build(aligned block, texts)`` returns for ``fields``."""
    names = ["row", *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices([len(t) for t in texts], BLOCK_CHARS):
                block = align_block(texts[a:b], *paths)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *build(block, b - a)], names)

    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").alias("_text"))
    return rows.mapInArrow(run, f"row {docs.select(*keep).schema.simpleString()}, {fields}")


def align(docs: DataFrame, path_a: str, path_b: str, keep: list[str]) -> DataFrame:
    """``row``, the ids ``a`` and ``b``, how many of them each group holds, and the linked positions in them."""
    def build(x: Aligned, n: int) -> list[pa.Array]:
        doc, group = x.document("links"), x.document("groups")
        order = np.lexsort((x.link_b, x.link_a))
        counts, groups = np.bincount(doc, minlength=n), np.bincount(group, minlength=n)
        i32 = pa.int32()
        return [_lists(x.a, np.diff(x.first_a), i32), _lists(x.b, np.diff(x.first_b), i32),
                _lists(np.diff(x.end_a, prepend=-1), groups, i32), _lists(np.diff(x.end_b, prepend=-1), groups, i32),
                _lists((x.link_a - x.first_a[doc])[order], counts, i32), _lists((x.link_b - x.first_b[doc])[order], counts, i32)]

    fields = "a array<int>, b array<int>, group_a array<int>, group_b array<int>, link_a array<int>, link_b array<int>"
    return _map(docs, keep, (path_a, path_b), fields, build)


_DECIMALS: dict[int, np.ndarray] = {}


def decimals(size: int) -> np.ndarray:
    """The ids as text before each separator; row 0 is ``,``, row 1 ``|``, row 2 ``;``, row 3 nothing."""
    if size not in _DECIMALS:
        _DECIMALS[size] = np.array([[b"%d%s" % (i, s) for i in range(size)] for s in (b",", b"|", b";", b"")], object)
    return _DECIMALS[size]


def group_texts(x: Aligned) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text: the ids of its groups in order."""
    size = max(int(x.a.max(initial=0)), int(x.b.max(initial=0))) + 1
    words = decimals(1 << (size - 1).bit_length())
    mark_a, mark_b = np.zeros(len(x.a), np.int8), np.zeros(len(x.b), np.int8)
    mark_a[x.end_a], mark_b[x.end_b] = 1, 2
    held = np.diff(x.first_b) > 0
    mark_b[x.first_b[1:][held] - 1] = 3
    place_a = np.arange(len(x.a)) + np.append(0, x.end_b + 1)[np.searchsorted(x.end_a, np.arange(len(x.a)))]
    place_b = np.arange(len(x.b)) + (x.end_a + 1)[np.searchsorted(x.end_b, np.arange(len(x.b)))]
    out = np.empty(len(x.a) + len(x.b), object)
    out[place_a] = words[mark_a, x.a]
    out[place_b] = words[mark_b, x.b]
    parts = out.tolist()
    ends = x.first_a + x.first_b
    return [b"".join(parts[s:e]) for s, e in zip(ends, ends[1:])]


def _pairs(x: Aligned, n: int) -> list[pa.Array]:
    """Counts of a block's texts, the digest of their groups, and their distinct id pairs with multiplicity."""
    doc = x.document("links")
    pair = x.a[x.link_a].astype(np.int64) << BITS | x.b[x.link_b].astype(np.int64)
    names, at = np.unique(pair, return_inverse=True)
    key, times = np.unique(doc * max(len(names), 1) + at, return_counts=True)
    owner = key // max(len(names), 1)
    per = np.bincount(owner, minlength=n)
    shas = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(x)]
    return [pa.array(np.diff(x.first_a), pa.int64()), pa.array(np.diff(x.first_b), pa.int64()),
            pa.array(np.bincount(x.document("groups"), minlength=n), pa.int64()),
            pa.array(np.bincount(doc, minlength=n), pa.int64()), pa.array(shas, pa.string()),
            _lists(names[key % max(len(names), 1)] if len(names) else key, per, pa.int64()), _lists(times, per, pa.int32())]


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: distinct pairs and how many links hold them."""
    for batch in batches:
        names, at = np.unique(batch.column(0).flatten().to_numpy(), return_inverse=True)
        n = np.bincount(at, batch.column(1).flatten().to_numpy(), len(names)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(n)], ["pair", "n"])


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, count, best): links of each id pair over all documents, and whether no pair of its B id has more."""
    counts = staged(documents.select("pairs", "times").mapInArrow(_tally, "pair long, n long")
                    .groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    b = F.col("pair").bitwiseAND((1 << BITS) - 1)
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def digest(docs: DataFrame, path_a: str, path_b: str, keep: list[str]) -> DataFrame:
    """``row`` with each document's counts, group digest, and sums over its links of the corpus-wide pair counts."""
    spark = docs.sparkSession
    fields = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")
    rows = staged(_map(docs, keep, (path_a, path_b), fields, _pairs).withColumn("rid", F.monotonically_increasing_id()), "aligned")
    counts = staged(pair_counts(rows), "pairs")
    total = counts.agg(F.sum("count").alias("n")).first()["n"] or 0
    heavy = counts.filter(F.col("count") > total // HEAVY).orderBy("pair").toArrow()  # at most HEAVY pairs
    known = spark.sparkContext.broadcast((heavy["pair"].to_numpy(), heavy["count"].to_numpy(),
                                          heavy["best"].to_numpy(zero_copy_only=False)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the heavy pairs of each row, and its other pairs."""
        names, count, best = known.value
        for batch in batches:
            pairs, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(names, pairs), max(len(names) - 1, 0))
            hit = names[at] == pairs if len(names) else np.zeros(len(pairs), bool)
            sums, n_best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, owner[hit], times[hit] * count[at[hit]])
            np.add.at(n_best, owner[hit], times[hit] * best[at[hit]])
            per = np.bincount(owner[~hit], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums), pa.array(n_best), _lists(pairs[~hit], per, pa.int64()),
                 _lists(times[~hit], per, pa.int64())], ["rid", "sums", "n_best", "pairs", "times"])

    weighed = staged(rows.select("rid", "pairs", "times").mapInArrow(
        weigh, "rid long, sums long, n_best long, pairs array<long>, times array<long>"), "weighed")
    light = (weighed.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("rid", "p.pairs", "p.times")
             .join(counts.withColumnRenamed("pair", "pairs"), "pairs")
             .select("rid", (F.col("times") * F.col("count")).alias("sums"),
                     F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best")))
    sums = weighed.select("rid", "sums", "n_best").unionByName(light).groupBy("rid").agg(
        F.sum("sums").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return rows.drop("pairs", "times").join(sums, "rid").select(
        "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
