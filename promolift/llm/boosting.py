"""Gradient-boosted trees for two classes, by histograms, in numpy."""

from __future__ import annotations

import numpy as np


class Trees:
    """Trees of one fixed depth, kept as arrays: feature and threshold of every inner
    node (children of node i are 2i + 1 and 2i + 2), and a value of every leaf."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, l2: float = 1.0, share: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2, self.share = rounds, depth, rate, bins, l2, share
        self.base, self.feature, self.threshold, self.leaf = 0.0, [], [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        n, f = x.shape
        if n == 0 or len(set(y.tolist())) < 2:
            self.base = 0.0 if n == 0 else 4.0 * float(y[0]) - 2.0
            return self
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(f)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]).astype(np.uint8)
        rate = float(y.mean())
        self.base = float(np.log(rate / (1 - rate)))
        odds = np.full(n, self.base)
        inner, rng = 2 ** self.depth - 1, np.random.default_rng(0)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-odds))
            g, h = y - p, p * (1 - p)
            some = np.arange(n) if self.share >= 1 else np.flatnonzero(rng.random(n) < self.share)   # rows that choose the splits
            few, gs, hs = binned[:, some], g[some], h[some]
            feature, threshold, at = np.zeros(inner, np.int32), np.full(inner, np.inf), np.zeros(n, np.int64)
            for d in range(self.depth):
                first, width = 2 ** d - 1, 2 ** d
                place = (at[some] - first) * self.bins
                gl, hl = np.empty((width, f, self.bins)), np.empty((width, f, self.bins))
                for j in range(f):      # one feature at a time stays in the cache
                    index = place + few[j]
                    gl[:, j] = np.bincount(index, gs, width * self.bins).reshape(width, self.bins)
                    hl[:, j] = np.bincount(index, hs, width * self.bins).reshape(width, self.bins)
                gl, hl = gl.cumsum(2), hl.cumsum(2)
                gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
                gain = gl ** 2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt ** 2 / (ht + self.l2)
                gain[(hl < 1) | (ht - hl < 1)] = 0
                best = gain.reshape(width, -1).argmax(1)
                for k in range(width):
                    j, b = divmod(int(best[k]), self.bins)
                    if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                        feature[first + k], threshold[first + k] = j, edges[j][b]
                at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
            own = at - inner
            value = np.bincount(own, g, inner + 1) / (np.bincount(own, h, inner + 1) + self.l2) * self.rate
            odds += value[own]
            self.feature.append(feature), self.threshold.append(threshold), self.leaf.append(value)
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of every row."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += leaf[at - (2 ** self.depth - 1)]
        return out
