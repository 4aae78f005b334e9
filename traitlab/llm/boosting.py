"""Small gradient-boosted trees for the logistic loss (numpy)."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Depth-limited trees over quantile-binned features, second-order gains."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 16,
                 penalty: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.penalty = trees, depth, rate, bins, penalty
        self.prior = 0.0
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.prior = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
        score = np.full(len(y), self.prior)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            score += self._grow(binned, edges, y - p, p * (1 - p))
        return self

    def _grow(self, binned, edges, gradient, hessian) -> np.ndarray:
        """Add one tree (heap order: children of n at 2n+1 and 2n+2)."""
        size = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        place, bins = np.zeros(binned.shape[1], np.int64), self.bins
        for node in range(size):
            rows = np.flatnonzero(place == node)
            if not len(rows):
                continue
            g, h = gradient[rows], hessian[rows]
            total_g, total_h = g.sum(), h.sum()
            value[node] = self.rate * total_g / (total_h + self.penalty)
            if 2 * node + 2 >= size or len(rows) < 10:
                continue
            best = (1e-6, -1, 0)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                b = binned[f, rows]
                left_g = np.cumsum(np.bincount(b, g, bins))[:len(edge)]
                left_h = np.cumsum(np.bincount(b, h, bins))[:len(edge)]
                gain = (left_g ** 2 / (left_h + self.penalty)
                        + (total_g - left_g) ** 2 / (total_h - left_h + self.penalty)
                        - total_g ** 2 / (total_h + self.penalty))
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
            if best[1] >= 0:
                _, f, k = best
                feature[node], cut[node] = f, edges[f][k]
                place[rows] = np.where(binned[f, rows] <= k, 2 * node + 1, 2 * node + 2)
        self.nodes.append((feature, cut, value))
        return value[place]

    def probability(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.prior), np.arange(len(x))
        for feature, cut, value in self.nodes:
            place = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[place]
                right = x[rows, f] > cut[place]
                place = np.where(f < 0, place, 2 * place + 1 + right)
            score += value[place]
        return 1 / (1 + np.exp(-score))
