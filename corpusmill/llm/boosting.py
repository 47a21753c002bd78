"""Gradient-boosted trees on histograms, with logistic loss and calibration by a temperature, in numpy.

For bounded training samples on the driver; scoring runs anywhere.
"""

from __future__ import annotations

import numpy as np

#: Share of hand-checked texts of either class that the statistics may not tell from the other one.
ODD = 0.03


class BoostedTrees:
    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0, least: int = 5):
        self.rounds, self.depth, self.rate, self.bins, self.ridge, self.least = rounds, depth, rate, bins, ridge, least
        self.base, self.scale, self.odd = 0.0, 1.0, 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """x: rows by features, y: 0 or 1."""
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T, strict=True)], 1)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, step = self._grow(binned, edges, y - p, p * (1 - p))
            self.trees.append(tree)
            score += step
        return self

    def _grow(self, binned: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray):
        size = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        node = np.zeros(len(grad), int)
        for i in range(size):
            rows = np.nonzero(node == i)[0]
            g, h = grad[rows].sum(), hess[rows].sum()
            value[i] = self.rate * g / (h + self.ridge)
            if i >= 2**self.depth - 1 or len(rows) < 2 * self.least:
                continue
            best, at = 1e-6, None
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                b, k = binned[rows, f], len(e) + 1
                gl, hl, nl = (np.cumsum(np.bincount(b, v, k))[:-1] for v in (grad[rows], hess[rows], None))
                gain = gl**2 / (hl + self.ridge) + (g - gl) ** 2 / (h - hl + self.ridge) - g**2 / (h + self.ridge)
                gain[(nl < self.least) | (len(rows) - nl < self.least)] = -1
                j = int(gain.argmax())
                if gain[j] > best:
                    best, at = gain[j], (f, j)
            if at:
                f, j = at
                feature[i], cut[i] = f, edges[f][j]
                right = binned[rows, f] > j
                node[rows[~right]], node[rows[right]] = 2 * i + 1, 2 * i + 2
        return (feature, cut, value), value[node]

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                right = x[np.arange(len(x)), np.maximum(f, 0)] >= cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += value[node]
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray, odd: float = ODD) -> BoostedTrees:
        """Temperature scaling on held-out rows: p = odd + (1 - 2 odd) * logistic(scale * score), of the least log loss.

        The trees decide at score 0; held-out rows are too few to move that border, but they tell how
        sure the scores are. A share `odd` of either class may look like the other one to the
        features, so that a few such rows don't bend the curve of all others.
        """
        s = self.score(x)
        n1, n0 = y.sum(), (1 - y).sum()
        t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        scales = np.geomspace(0.01, 10, 601)
        q = odd + (1 - 2 * odd) / (1 + np.exp(-np.clip(scales[:, None] * s, -500, 500)))
        loss = -(t * np.log(q) + (1 - t) * np.log(1 - q)).sum(1)
        self.scale, self.odd = float(scales[loss.argmin()]), odd
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.odd + (1 - 2 * self.odd) / (1 + np.exp(-np.clip(self.scale * self.score(x), -500, 500)))
