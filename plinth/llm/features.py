"""Hashed n-gram features over byte arrays, and the linear models that use them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from plinth.llm.batches import U64, span_hashes


def char_grams(buf: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each n of ``sizes``: n, the bucket of the n bytes at each position, and which lie in one text.

    ``ends`` are the places of the separators that follow each text in ``buf``.
    """
    h = np.zeros(len(buf), U64)
    for n in range(1, max(sizes) + 1):
        m = len(buf) - n + 1
        if m <= 0:
            return
        h = h[:m] * U64(1000003) + buf[n - 1:n - 1 + m] + U64(1)
        if n in sizes:
            inside = np.ones(m, bool)
            for back in range(n):
                at = ends - back
                inside[at[(at >= 0) & (at < m)]] = False
            buckets = ((h + U64(n)) * U64(0x9E3779B97F4A7C15)) >> U64(64 - bits)
            yield n, buckets.astype(np.int32), inside


def word_buckets(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each word."""
    return (span_hashes(buf, starts, ends) >> U64(64 - bits)).astype(np.int32)


def fit_logistic(
    rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, n_cols: int,
    penalty: float, steps: int = 200, rate: float = 0.05,
) -> tuple[np.ndarray, float]:
    """Logistic regression on a sparse matrix by full-batch Adam with an L2 penalty; deterministic."""
    n = max(len(y), 1)
    w = np.zeros(n_cols)
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-4), 1 - 1e-4)
    b = float(np.log(share / (1 - share)))
    m1, m2, b1, b2 = np.zeros(n_cols), np.zeros(n_cols), 0.0, 0.0
    for k in range(1, steps + 1):
        z = b + np.bincount(rows, values * w[cols], n)
        error = sigmoid(z) - y if len(y) else np.zeros(n)
        g = np.bincount(cols, values * error[rows], n_cols) / n + penalty * w
        gb = float(error.mean())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.999 * b2 + 0.001 * gb * gb
        w -= rate * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.999**k)) + 1e-8)
        b -= rate * (b1 / (1 - 0.9**k)) / (np.sqrt(b2 / (1 - 0.999**k)) + 1e-8)
    return w, b


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
