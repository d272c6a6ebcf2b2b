"""Logistic models on sparse presence features, fitted on bounded samples."""

from __future__ import annotations

import numpy as np


class Sparse:
    """Rows of (column, value) pairs."""

    def __init__(self, columns: list[np.ndarray], values: list[np.ndarray] | None, width: int):
        self.width = width
        self.row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
        self.column = np.concatenate(columns).astype(np.int64) if columns else np.empty(0, np.int64)
        self.value = np.concatenate(values) if values else np.ones(len(self.column))
        self.rows = len(columns)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column] * self.value, self.rows)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, r[self.row] * self.value, self.width)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Sparse, dense: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, rounds: int = 80, rate: float = 0.3, penalty: float = 1e-4) -> np.ndarray:
    """Weights of x's columns, then of dense's, then the bias, by full-batch Adam. y may be probabilities."""
    weight = np.ones(len(y)) if weight is None else weight
    w = np.zeros(x.width + dense.shape[1] + 1)
    p = np.clip(np.average(y, weights=weight) if weight.sum() else 0.5, 1e-3, 1 - 1e-3)
    w[-1] = np.log(p / (1 - p))
    m, v, total = np.zeros_like(w), np.zeros_like(w), max(weight.sum(), 1e-9)
    for t in range(1, rounds + 1):
        r = (sigmoid(x.times(w[: x.width]) + dense @ w[x.width : -1] + w[-1]) - y) * weight / total
        g = np.concatenate([x.back(r), dense.T @ r, [r.sum()]])
        g[:-1] += penalty * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (0.5 + 0.5 * np.cos(np.pi * t / rounds)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def predict(x: Sparse, dense: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x.times(w[: x.width]) + dense @ w[x.width : -1] + w[-1])
