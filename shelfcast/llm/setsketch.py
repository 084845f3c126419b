"""SetSketch registers: exponentially spaced truncated minima of hashed elements.

Register ``i`` of a set is ``floor(1 - log_b(min over elements of an Exp(a)
value))``, clipped to [0, q + 1].  It depends only on the set, a union's
register is the maximum of the parts' registers, and two sets agree in a register
with a probability that rises with their Jaccard similarity; so registers both
band (candidates) and feed a joint likelihood (estimate).
"""

from __future__ import annotations

import numpy as np

from shelfcast.llm.shingles import U

BASE, RATE, Q = 1.001, 20.0, 65_534


def multipliers(m: int) -> np.ndarray:
    return np.random.default_rng(0xB0B).integers(0, 2**63, m, dtype=np.uint64) * U(2) + U(1)


def registers(elements: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """uint16 registers (rows, m) of the sets ``elements[bounds[i]:bounds[i + 1]]``; empty sets get 0."""
    out = np.zeros((len(bounds) - 1, m), np.uint16)
    rows = np.flatnonzero(np.diff(bounds) > 0)
    if len(rows) == 0:
        return out
    starts = bounds[rows]
    least = np.empty((m, len(rows)), np.uint64)
    for i, odd in enumerate(multipliers(m)):
        least[i] = np.minimum.reduceat(elements * odd, starts)
    uniform = (least.T.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-uniform) / RATE
    out[rows] = np.clip(np.floor(1.0 - np.log(exponential) / np.log(BASE)), 0, Q + 1).astype(np.uint16)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1.0) / BASE) / np.log(BASE)


def jaccard_likelihood(up: np.ndarray, down: np.ndarray, same: np.ndarray, na: np.ndarray, nb: np.ndarray,
                       steps: int = 25) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of set pairs.

    ``up``, ``down``, ``same``: registers in which the first set's value is larger,
    smaller, equal; ``na``, ``nb``: the set sizes, known exactly.  The likelihood
    is concave in the similarity, so golden-section search finds its top.
    """
    u, v = na / (na + nb), nb / (na + nb)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def likelihood(j):
        p, q = _p(np.clip(u - v * j, 0, 1)), _p(np.clip(v - u * j, 0, 1))
        tiny = 1e-300
        return up * np.log(p + tiny) + down * np.log(q + tiny) + same * np.log(np.maximum(1 - p - q, 0) + tiny)

    g = (np.sqrt(5.0) - 1) / 2
    for _ in range(steps):
        x, y = high - g * (high - low), low + g * (high - low)
        left = likelihood(x) > likelihood(y)
        high, low = np.where(left, y, high), np.where(left, low, x)
    return (low + high) / 2


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Estimated similarity of the register rows ``x`` and ``y``, pair by pair."""
    m = x.shape[1]
    same = (x == y).sum(1)
    up = (x > y).sum(1)
    return jaccard_likelihood(up, m - up - same, same, nx.astype(float), ny.astype(float))
