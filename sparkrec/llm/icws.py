"""Improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import numpy as np

from sparkrec.llm.shingles import Shingles, U, mix

BUCKET_BITS = 18  # hashing trick: inverse document frequencies are kept for 2**18 buckets of shingles
SAMPLES = 20
DAMPING = 0.02
_SEEDS = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


def bucket(keys: np.ndarray) -> np.ndarray:
    return (keys >> U(64 - BUCKET_BITS)).astype(np.int64)


def inverse_frequency(counts: np.ndarray, documents: int) -> np.ndarray:
    """Per bucket ``1 + DAMPING * ln((N + 1) / (df + 1)) / ln(N + 1)``, from 1 (in every document) to 1 + DAMPING (rare)."""
    n = np.log(documents + 1.0)
    return (1 + DAMPING * np.clip(np.log((documents + 1) / (counts + 1.0)), 0, n) / max(n, 1e-9)).astype(np.float32)


def weights(s: Shingles, idf: np.ndarray) -> np.ndarray:
    """Damped term frequency ``1 + DAMPING * (1 - 1 / count)`` times inverse document frequency.

    Weights lie between 1 and ``(1 + DAMPING) ** 2``, so neither repeats within a
    text nor shingles made frequent by a group of copies hide a copy: a text and
    the same text pasted often have at least ``1 / (1 + DAMPING)``, and texts of
    plain similarity J at least ``least_weighted(J)`` (0.7816 for J = 0.8).
    """
    tf = 1 + DAMPING * (1 - 1 / s.counts.astype(np.float32))
    return (tf * idf[bucket(s.keys)]).astype(np.float32)


def least_weighted(similarity: float) -> float:
    """The least weighted Jaccard similarity that texts of this plain similarity can have."""
    top = 1 + DAMPING
    return similarity / (similarity * top + (1 - similarity) * top * top)


def samples(s: Shingles, weight: np.ndarray, n_samples: int = SAMPLES) -> np.ndarray:
    """(texts, n_samples) 32-bit samples; two texts agree in one with their weighted Jaccard similarity.

    For each sample and shingle: r, c ~ Gamma(2, 1), b ~ U(0, 1) from the
    shingle's hash, t = floor(ln w / r + b), ln a = ln c - r (t - b) - r; the
    shingle of least a, with its t, is the sample.  Texts without shingles get 0.
    """
    sizes = np.diff(s.first)
    out = np.zeros((len(sizes), n_samples), np.uint32)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    starts, lens = s.first[:-1][full], sizes[full]
    ln_w = np.log(weight)
    low = U(0xFFFFFFFF)
    scale = np.float32(2.0 ** -32)
    for k in range(n_samples):
        a = mix(s.keys + _SEEDS[k])
        b = mix(a ^ _SEEDS[-1 - k])
        half = np.float32(0.5)
        r = -np.log(((a & low).astype(np.float32) + half) * scale) - np.log(((a >> U(32)).astype(np.float32) + half) * scale)
        c = -np.log(((b & low).astype(np.float32) + half) * scale) - np.log(((b >> U(32)).astype(np.float32) + half) * scale)
        r = np.maximum(r, np.float32(1e-6))
        beta = ((a ^ (b >> U(17))) & U(0xFFFFFF)).astype(np.float32) * np.float32(2.0 ** -24)
        t = np.floor(ln_w / r + beta)
        ln_a = np.log(np.maximum(c, np.float32(1e-6))) - r * (t - beta) - r
        least = np.minimum.reduceat(ln_a, starts)
        hit = np.flatnonzero(ln_a == np.repeat(least, lens))
        hit = hit[np.searchsorted(hit, starts)]
        out[full, k] = (mix(s.keys[hit] ^ mix(t[hit].astype(np.int64).astype(U) + U(k))) >> U(32)).astype(np.uint32)
    return out
