"""Gradient-boosted trees for a yes/no target, trained with numpy on binned features."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Complete binary trees of ``depth`` levels over features binned at quantiles, fitted to the logistic loss."""

    rounds: int = 40
    depth: int = 4
    rate: float = 0.3
    bins: int = 32
    smooth: float = 1.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], 1).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(col, np.linspace(0, 1, self.bins + 1)[1:-1])) for col in x.T]
        b, n, m = self._binned(x).astype(np.int64), *x.shape
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        score = np.full(n, self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            grad, hess = y - q, q * (1 - q)
            leaf = np.zeros(n, np.int64)
            feature, cut = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, 255, np.int64)
            for level in range(self.depth):
                width, first = 1 << level, (1 << level) - 1
                gain = np.full((m, width, self.bins), -1.0)
                for k in range(m):
                    at = leaf * self.bins + b[:, k]
                    g = np.bincount(at, grad, width * self.bins).reshape(width, -1).cumsum(1)
                    h = np.bincount(at, hess, width * self.bins).reshape(width, -1).cumsum(1)
                    g_all, h_all = g[:, -1:], h[:, -1:]
                    gain[k] = (g**2 / (h + self.smooth) + (g_all - g) ** 2 / (h_all - h + self.smooth)
                               - g_all**2 / (h_all + self.smooth))
                for j in range(width):
                    k, c = np.unravel_index(np.argmax(gain[:, j]), gain[:, j].shape)
                    if gain[k, j, c] > 1e-6:
                        feature[first + j], cut[first + j] = k, c
                leaf = 2 * leaf + (b[np.arange(n), feature[first + leaf]] > cut[first + leaf])
            g = np.bincount(leaf, grad, 1 << self.depth)
            h = np.bincount(leaf, hess, 1 << self.depth)
            value = self.rate * g / (h + self.smooth)
            self.trees.append((feature, cut, value))
            score += value[leaf]
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b, rows = self._binned(x), np.arange(len(x))
        score = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = (1 << level) - 1 + leaf
                leaf = 2 * leaf + (b[rows, feature[node]] > cut[node])
            score += value[leaf]
        return score
