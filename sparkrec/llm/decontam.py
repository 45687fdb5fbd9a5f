"""Benchmark decontamination (7): q-gram lemma filtering and banded alignment.

Texts and benchmark items are normalised (lower case, runs of other characters
than letters and digits to one blank).  An item of m characters that occurs in
a text with at most e edits shares at least ``m - q + 1 - q e`` character
q-grams with it, all within 2e + 1 neighbouring diagonals (text position less
item position); edits in w runs, such as replaced words, leave
``m - q + 1 - e - w (q - 1)``.  Every text position is looked up in the items'
q-gram index, hits are counted in overlapping diagonal bands of twice that
width, and bands that reach their bound are verified by banded alignment of the
whole item.  This is done for ``EDIT_SHARE`` edits anywhere, and in wider bands
for ``RUN_SHARE`` in a few runs (one for every ``RUN_CHARS`` characters).  Items of
more than two windows are also indexed as windows of ``WINDOW`` characters,
one every ``STEP``, found in the same way: a passage of ``WINDOW + STEP``
characters holds a whole one.  A row of a window has ``WINDOW`` item_chars and
the window's edits, and is left out where the whole item is found.

Items are indexed on the driver in blocks of at most ``INDEX_CHARS`` and
broadcast; a larger benchmark takes more passes over the texts.

Defined cases: null or empty texts hold nothing; items that are null or shorter
than ``MIN_CHARS`` after normalisation prove nothing and take no part; repeated
items and repeated documents are each reported; texts are searched whole;
characters beyond Latin-1 are folded to one byte each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import annotate, slices
from sparkrec.llm.shingles import BASE, NOT_WORD, SPACED, U, powers

Q = 10
EDIT_SHARE = 0.07  # edits allowed per character of an item, wherever they are
RUN_SHARE = 0.2  # and in a few runs
RUN_CHARS = 40
MIN_CHARS = 25
WINDOW = 80
STEP = 40
INDEX_CHARS = 1 << 22
BLOCK = 1 << 19
MATCH_TYPE = "array<struct<item_id:bigint,start:bigint,end:bigint,edits:int,item_chars:int>>"
MATCH_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("edits", pa.int32()), ("item_chars", pa.int32())]))
BLANKS = re.compile(b"  +")


def normalised(text: str | None) -> bytes:
    """One byte per character: letters and digits in lower case, single blanks between."""
    low = (text or "").lower()
    try:
        data = low.encode("latin-1").translate(SPACED)
    except UnicodeEncodeError:
        code = np.frombuffer(NOT_WORD.sub(" ", low).encode("utf-32-le"), "<u4")
        data = np.where(code < 256, code, 128 + (code * np.uint32(2654435761) >> np.uint32(25))).astype(np.uint8).tobytes()
    return BLANKS.sub(b" ", data).strip()


def qgram_keys(data: np.ndarray, q: int = Q) -> np.ndarray:
    if len(data) < q:
        return np.zeros(0, U)
    sums = np.concatenate([np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(data)))])
    return (sums[q:] - sums[:-q]) * powers(pow(BASE, -1, 1 << 64), len(data) - q + 1)


def budget(m: int) -> int:
    """Edits allowed in an item of ``m`` characters, small enough for the lemma to ask at least one q-gram."""
    return max(0, min(int(EDIT_SHARE * m), (m - Q) // Q))


def runs(m: int) -> int:
    return max(1, m // RUN_CHARS)


def limit(m: int) -> int:
    """Edits allowed in runs: as many as leave at least the q-grams that ``budget`` asks for."""
    return max(budget(m), min(int(RUN_SHARE * m), Q * budget(m) - runs(m) * (Q - 1)))


def needed(m: int, wide: bool) -> int:
    """q-grams that an item of ``m`` characters shares with a text that holds it within ``budget``, or ``limit`` in runs."""
    lost = limit(m) + runs(m) * (Q - 1) if wide else Q * budget(m)
    return max(1, m - Q + 1 - lost)


@dataclass
class Index:
    """q-grams of a block of items with their postings, and a bitmap that most text positions fail."""

    ids: list
    items: list[np.ndarray]
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bits: int
    bitmap: np.ndarray


def build_index(rows: list[tuple[int, str]]) -> Index:
    items = [(i, np.frombuffer(normalised(t), np.uint8)) for i, t in rows]
    items = [(i, d) for i, d in items if len(d) >= MIN_CHARS]
    items += [(i, d[a:a + WINDOW]) for i, d in items if len(d) > 2 * WINDOW
              for a in [*range(0, len(d) - WINDOW, STEP), len(d) - WINDOW]]
    keys = [qgram_keys(d) for _, d in items]
    flat = np.concatenate([np.zeros(0, U), *keys])
    item = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(k)) for k in keys)])
    order = np.argsort(flat, kind="stable")
    unique, first = np.unique(flat[order], return_index=True)
    bits = max(10, int(len(unique)).bit_length() + 5)
    bitmap = np.zeros(1 << bits, bool)
    bitmap[(unique >> U(64 - bits)).astype(np.int64)] = True
    return Index([i for i, _ in items], [d for _, d in items], unique, np.append(first, len(flat)),
                 item[order], place[order], bits, bitmap)


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, limit: int) -> tuple[int, int] | None:
    """(edits, end) of the whole item in ``text``, free to start and end, on diagonals ``low`` to ``high``."""
    width = high - low + 1
    big = len(item) + len(text) + 1
    slot = np.arange(width)
    at = low + slot  # text characters consumed before item row 0
    row = np.where((at >= 0) & (at <= len(text)), 0, big)
    for i, c in enumerate(item):
        at = low + slot + i + 1  # text characters consumed after this row
        inside = (at >= 1) & (at <= len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside] - 1] == c
        new = np.where(inside, row + ~same, big)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # item character deleted
        new = np.where((at >= 0) & (at <= len(text)), new, big)
        row = np.minimum.accumulate(new - slot) + slot  # text characters inserted
        if row.min() > limit:
            return None
    best = int(row.argmin())
    end = low + best + len(item)
    return (int(row[best]), end) if row[best] <= limit and 0 <= end <= len(text) else None


def occurrences(index: Index, text: np.ndarray, k: int, band: int, e: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of item ``k`` in ``text`` on the band's diagonals, if within ``e`` edits."""
    item = index.items[k]
    step = 2 * e + 1
    low, high = band * step, band * step + 2 * step - 1
    left, right = max(0, low - e), min(len(text), high + len(item) + e + 1)
    part = text[left:right]
    exact = part.tobytes().find(item.tobytes())
    if exact >= 0:  # an alignment without edits
        return 0, left + exact, left + exact + len(item)
    found = align(item, part, low - left, high - left, e)
    if not found:
        return None
    edits, end = found
    reverse = align(item[::-1], part[:end][::-1], -e, e, e)  # from the end found back to a start
    start = end - reverse[1] if reverse else max(0, end - len(item))
    return edits, left + start, left + end


def _full_bands(doc: np.ndarray, item: np.ndarray, band: np.ndarray, need: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, item, band) of the bands that hold as many hits as the item needs; a hit counts in both bands of its diagonal."""
    key = np.stack([np.tile(doc, 2), np.tile(item, 2), np.concatenate([band, band - 1])])
    order = np.lexsort(key[::-1])
    key = key[:, order]
    new = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0))) if key.shape[1] else np.zeros(0, int)
    count = np.diff(np.append(new, key.shape[1]))
    doc, item, band = key[:, new]
    yield from zip(*(x[count >= need[item]].tolist() for x in (doc, item, band)))


def search(index: Index, texts: list[bytes]) -> list[list[dict]]:
    """Matches of every text (start and end in normalised characters)."""
    out: list[list[dict]] = [[] for _ in texts]
    if not index.ids:
        return out
    data = np.frombuffer(b"\x00".join(texts), np.uint8)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    keys = qgram_keys(data)
    at = np.flatnonzero(index.bitmap[(keys >> U(64 - index.bits)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(index.keys, keys[at]), len(index.keys) - 1)
    real = index.keys[slot] == keys[at]
    at, slot = at[real], slot[real]
    n = index.first[slot + 1] - index.first[slot]
    post = np.repeat(index.first[slot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(at, n)
    doc = np.searchsorted(starts, at, "right") - 1
    item = index.item[post]
    diagonal = at - starts[doc] - index.place[post]
    sizes = np.array([len(d) for d in index.items])
    for wide in (False, True):
        edits = np.array([limit(m) if wide else budget(m) for m in sizes])
        need = np.array([needed(m, wide) for m in sizes])
        band = diagonal // (2 * edits[item] + 1)
        for d, k, b in _full_bands(doc, item, band, need):
            hit = occurrences(index, data[starts[d]:starts[d] + len(texts[d])], k, b, int(edits[k]))
            if hit:
                row = {"item_id": index.ids[k], "start": hit[1], "end": hit[2], "edits": hit[0], "item_chars": int(sizes[k])}
                if row not in out[d]:
                    out[d].append(row)
    return [distinct_regions(rows) for rows in out]


def distinct_regions(rows: list[dict]) -> list[dict]:
    """Of overlapping regions of one item the one with fewest edits, of the whole item before its windows."""
    kept: list[dict] = []
    for r in sorted(rows, key=lambda r: (r["item_id"], r["item_chars"] == WINDOW, r["edits"], r["start"])):
        if not any(k["item_id"] == r["item_id"] and r["start"] < k["end"] and k["start"] < r["end"] for k in kept):
            kept.append(r)
    return sorted(kept, key=lambda r: (r["start"], r["item_id"]))


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the items, a block of bounded size at a time."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = (1 + WINDOW // STEP) * chars // INDEX_CHARS + 1  # windows too
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield build_index(sorted((r["item_id"], r["text"]) for r in rows if r["item_id"] is not None))


def matched(docs: DataFrame, index: Index, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep``) and ``matches`` of every document against one index."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def score(texts: list) -> list:
        out: list = []
        for a, b in slices([len(t or "") for t in texts], BLOCK):
            out += search(shared.value, [normalised(t) for t in texts[a:b]])
        return [pa.array(out, MATCH_ARROW)]

    return annotate(docs, keep, score, f"matches {MATCH_TYPE}")


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, edits, item_chars): every place where a document holds an item."""
    parts = [matched(docs, index, ["doc_id"]).select("row.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
             for index in indexes(benchmark)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with their columns."""
    for index in indexes(benchmark):
        docs = matched(docs, index, docs.columns).filter(F.size("matches") == 0).select("row.*")
    return docs
