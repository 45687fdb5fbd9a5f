"""Word shingles of many texts at once, as 64-bit hashes (NumPy on normalised bytes)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np

from sparkrec.llm.common import slices

WORDS = 5
BLOCK = 1 << 19
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
SPACED = bytes(c if chr(c).isalnum() else 32 for c in range(256))
NOT_WORD = re.compile(r"[\W_]+")
U = np.uint64
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** (1..n)`` modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        _powers[base] = np.cumprod(np.full(max(n, 2 * BLOCK), base, U))
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (public constants)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def normal_bytes(text: str) -> bytes:
    """Lower case, every character that is no letter or digit a blank, in UTF-8."""
    low = text.lower()
    try:
        return low.encode("latin-1").translate(SPACED).decode("latin-1").encode()
    except UnicodeEncodeError:
        return NOT_WORD.sub(" ", low).encode()


@dataclass
class Words:
    """Hashes of the words of ``n`` texts; ``first[i]:first[i + 1]`` are those of text i."""

    keys: np.ndarray
    first: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    word = data != 32
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(data)))])
    keys = mix((sums[end] - sums[start]) * powers(pow(BASE, -1, 1 << 64), len(data))[start])
    at = np.cumsum([1] + [len(t) + 1 for t in texts])
    return Words(keys, np.searchsorted(start, at))


@dataclass
class Shingles:
    """Distinct shingles with counts, grouped by text; ``first`` as in ``Words``."""

    keys: np.ndarray
    counts: np.ndarray
    first: np.ndarray


def shingles_of(words: Words, size: int = WORDS) -> Shingles:
    """Texts of fewer than ``size`` words have one shingle of them all; texts without words none."""
    n = np.diff(words.first)
    total = len(words.keys)
    rolled = np.zeros(total, U)
    for j in range(min(size, total)):
        part = words.keys[j:] * U(pow(BASE, j + 1, 1 << 64))
        rolled[:total - j] += part
    per = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    text = np.repeat(np.arange(len(n)), per)
    ends = np.cumsum(per)
    at = words.first[text] + np.arange(len(text)) - (ends - per)[text]
    keys = rolled[at]
    for i in np.flatnonzero((n > 0) & (n < size)):
        a, b = words.first[i], words.first[i + 1]
        keys[ends[i] - 1] = (words.keys[a:b] * powers(BASE, b - a)).sum(dtype=U) + U(b - a)
    keys = mix(keys)
    _, first, counts = np.unique(mix(keys + text.astype(U) * U(BASE)), return_index=True, return_counts=True)
    order = np.argsort(text[first], kind="stable")
    first, counts = first[order], counts[order]
    return Shingles(keys[first], counts, np.searchsorted(text[first], np.arange(len(n) + 1)))


def digests(texts: list[bytes]) -> list[bytes | None]:
    """128 bits (BLAKE2) of each normalised text's word sequence; None without words."""
    return [blake2b(b" ".join(words), digest_size=16).digest() if (words := text.split()) else None for text in texts]


def blocks(texts: list, limit: int = BLOCK) -> Iterator[tuple[int, int, list[bytes]]]:
    """(from, to, normalised texts) of consecutive texts, about ``limit`` characters at a time; null as empty."""
    for a, b in slices([len(t or "") for t in texts], limit):
        yield a, b, [normal_bytes(t or "") for t in texts[a:b]]
