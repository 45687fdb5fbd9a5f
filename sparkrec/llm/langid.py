"""Language identification (6): prediction by partial matching with byte context trees.

Per language, a tree of byte contexts up to ``ORDER`` holds the counts seen in
a bounded sample of labelled texts.  With the statistics frozen, the cost of a
byte is ``-log2`` of its PPM probability (method C): count over total plus
distinct symbols in the longest known context, or that context's escape
probability times the estimate one order below, down to one of 256 bytes.  All
languages share one table per order, so a text is scored against all of them
in one pass; the smallest total code length wins.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
ties go to the smaller language name; with no labelled text every document is
``und``; languages are those of the labelled rows; texts are scored whole, in
blocks; other columns are ignored or carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import annotate, sample_by_hash, slices

ORDER = 4
PER_LANGUAGE = 300  # labelled texts a language is learned from
MAX_CHARS = 20_000  # longer texts are not eligible for the sample
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
BLOCK = 1 << 18
PAD = b"\n" * ORDER
MIX = np.uint64(0x9E3779B97F4A7C15)


def grams(text: bytes, order: int) -> np.ndarray:
    """Every byte with its ``order`` predecessors as one integer; ``text`` starts with the padding."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = len(data) - ORDER
    out = np.zeros(n, np.uint64)
    for back in range(order, -1, -1):
        out = out << np.uint64(8) | data[ORDER - back:ORDER - back + n]
    return out


class Table:
    """Open-addressed map from gram to its row of costs; built and probed with NumPy."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.rows = rows.astype(np.float32)
        self.bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = self._slot(keys)
        out = self.slots[at]
        todo = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)
            out[todo] = found = self.slots[at[todo]]
            todo = todo[(found >= 0) & (self.keys[found] != keys[todo])]
        return out


@dataclass
class Model:
    languages: list[str]
    grams: list[Table]  # by order: full cost of a known gram in each language
    escapes: list[Table]  # by order: cost of escaping a known context in each language


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS) -> Model:
    """Learn from ``labelled`` (text, lang); the counts of the sample are summed in Spark."""
    sample = sample_by_hash(labelled, "lang", per_language, max_chars)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = PAD + text.lower().encode()
                for order in range(ORDER + 1):
                    key, n = np.unique(grams(data, order), return_counts=True)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(key), pa.string()), "k": pa.array([order] * len(key), pa.int32()),
                        "gram": pa.array(key.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    counts = (sample.mapInArrow(count, "lang string, k int, gram long, n long")
              .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))).toArrow()
    return build(counts)


def build(counts: pa.Table) -> Model:
    """Frozen cost tables from (lang, k, gram, n) counts."""
    languages = sorted(counts["lang"].unique().to_pylist())
    code = counts["lang"].combine_chunks().dictionary_encode()
    to = np.array([languages.index(x) for x in code.dictionary.to_pylist()], np.int64)
    lang_of, k_of = to[code.indices.to_numpy()], counts["k"].to_numpy()
    gram_of, n_of = counts["gram"].to_numpy().astype(np.uint64), counts["n"].to_numpy().astype(np.float64)
    n_lang = len(languages)
    tables: list[Table] = []
    escapes: list[Table] = []
    lower: Model = Model(languages, tables, escapes)
    for order in range(ORDER + 1):
        here = k_of == order
        gram, lang, n = gram_of[here], lang_of[here], n_of[here]
        keys, at = np.unique(gram, return_inverse=True)
        contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
        seen = np.zeros((len(keys), n_lang))
        seen[at, lang] = n
        total, distinct = np.zeros((len(contexts), n_lang)), np.zeros((len(contexts), n_lang))
        np.add.at(total, of, seen)
        np.add.at(distinct, of, seen > 0)
        escape = np.where(total > 0, -np.log2(np.maximum(distinct, 1) / np.maximum(total + distinct, 1)), 0.0)
        below = known_cost(lower, order - 1, keys)
        known = -np.log2(np.maximum(seen, 1) / np.maximum((total + distinct)[of], 1))
        rows = np.where(seen > 0, known, escape[of] + below)
        tables.append(Table(keys, rows))
        escapes.append(Table(contexts, escape))
    return lower


def known_cost(model: Model, order: int, keys: np.ndarray) -> np.ndarray:
    """Cost rows of grams (given at ``order`` or above) under the orders up to ``order``."""
    cost = np.zeros((len(keys), len(model.languages)), np.float32)
    todo = np.arange(len(keys))
    for k in range(order, -1, -1):
        key = keys[todo] & np.uint64((1 << 8 * (k + 1)) - 1)
        row = model.grams[k].find(key)
        hit = row >= 0
        cost[todo[hit]] += model.grams[k].rows[row[hit]]
        todo, key = todo[~hit], key[~hit]
        if not len(todo):
            return cost
        row = model.escapes[k].find(key >> np.uint64(8))
        hit = row >= 0
        cost[todo[hit]] += model.escapes[k].rows[row[hit]]
    cost[todo] += 8
    return cost


def code_lengths(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bits per text and language, bytes per text)."""
    block = max(1 << 14, min(BLOCK, (4 * BLOCK) // max(1, len(model.languages))))
    sizes = np.zeros(len(texts), np.int64)
    bits = np.zeros((len(texts), len(model.languages)))
    for a, b in slices([len(t) for t in texts], block):
        data = [t.lower().encode() for t in texts[a:b]]
        sizes[a:b] = [len(d) for d in data]
        joined = PAD + b"".join(d + PAD for d in data)
        starts = np.cumsum(np.append(0, sizes[a:b] + ORDER))[:-1]
        for at in range(0, len(joined) - ORDER, block):  # one text longer than a block goes through in blocks
            key = grams(joined[at:at + block + ORDER], ORDER)
            cost = known_cost(model, ORDER, key)
            inside = np.searchsorted(starts, np.arange(at, at + len(key)), "right") - 1
            cost[np.arange(at, at + len(key)) >= (starts + sizes[a:b])[inside]] = 0
            first = np.flatnonzero(np.append(True, np.diff(inside) > 0))
            bits[a + inside[first]] += np.add.reduceat(cost, first, axis=0, dtype=np.float64)
    return bits, sizes


def predictor(spark, model: Model):
    shared = spark.sparkContext.broadcast(model)

    def score(texts: list) -> list:
        m = shared.value
        usable = [i for i, t in enumerate(texts) if m.languages and t and LETTER.search(t)]
        lang: list = [UNDETERMINED] * len(texts)
        conf, mean = np.zeros(len(texts)), np.full(len(texts), np.nan)
        if usable:
            bits, sizes = code_lengths(m, [texts[i] for i in usable])
            per_byte = bits / sizes[:, None]
            best = per_byte.argmin(1)
            rel = np.exp2(per_byte.min(1, keepdims=True) - per_byte)
            for i, j in zip(usable, best):
                lang[i] = m.languages[j]
            conf[usable] = 1 / rel.sum(1)
            mean[usable] = per_byte.min(1)
        return [pa.array(lang, pa.string()), pa.array(conf), pa.array(mean, from_pandas=True)]

    return score


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep``), ``lang_pred``, ``score`` and the winner's ``bits_per_byte`` for every document."""
    return annotate(docs, keep, predictor(docs.sparkSession, model), "lang_pred string, score double, bits_per_byte double")
