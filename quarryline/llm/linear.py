"""Linear hinge-loss models on hashed n-grams, and the sampling of their rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gram_codes(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hashed codes of all ``n``-grams of a byte array, in ``[0, 2 ** bits)``."""
    m = len(data) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    h = np.full(m, 0x9E3779B1 * n & 0xFFFFFFFF, np.uint32)
    for i in range(n):
        h ^= data[i : i + m]
        h *= np.uint32(0x01000193)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return (h >> np.uint32(32 - bits)).astype(np.int64)


def hinge_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, cost: np.ndarray, epochs: int = 12, seed: int = 0):
    """Weights and bias of a linear model with hinge loss by dual coordinate descent.

    ``rows`` are (indices, values), ``y`` is +1 or -1 and ``cost`` bounds each
    row's dual variable.  The bias is a feature that is always 1.
    """
    w, b = np.zeros(dims), 0.0
    alpha = np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            gradient = y[i] * (float(w[at] @ v) + b) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * v
                b += step
                alpha[i] = new
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return w, b


def margins(rows, w: np.ndarray, b: float) -> np.ndarray:
    return np.array([float(w[at] @ v) + b for at, v in rows])


def sigmoid_fit(m: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities of ``y == 1``."""
    target = np.where(y > 0, (np.sum(y > 0) + 1) / (np.sum(y > 0) + 2), 1 / (np.sum(y <= 0) + 2))
    a, c = 1.0, 0.0
    for _ in range(steps):  # Newton's method on a convex loss of two parameters
        p = 1 / (1 + np.exp(-np.clip(a * m + c, -35, 35)))
        e, s = p - target, p * (1 - p) + 1e-9
        g = np.array([e @ m, e.sum()])
        h = np.array([[s @ (m * m), s @ m], [s @ m, s.sum()]]) + 1e-6 * np.eye(2)
        d = np.linalg.solve(h, g)
        a, c = a - d[0], c - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(c)


def bounded_sample(rows: DataFrame, by: str, most: int, key: Column) -> DataFrame:
    """At most ``most`` rows of each value of ``by``, spread over all by hash.

    The class counts come from a map-side combined aggregate; a hash of ``key``
    then lets about ``most`` rows of a class through, and only these are ranked.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}
    if not counts:
        return rows.limit(0)
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, most / n))])
    spread = (F.xxhash64(key).bitwiseAND(F.lit((1 << 30) - 1))) / float(1 << 30)
    thin = rows.where(spread < F.element_at(share, F.col(by)))
    order = Window.partitionBy(by).orderBy(F.xxhash64(key), key)
    return thin.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most).drop("_rank")
