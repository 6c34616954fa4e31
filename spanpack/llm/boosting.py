"""Gradient-boosted regression trees for a logistic loss, on binned features."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees of a fixed depth as arrays: node ``i`` has children ``2i + 1`` and
    ``2i + 2``; a row goes right where its feature exceeds the node's edge."""

    def __init__(self, depth: int = 5, trees: int = 80, rate: float = 0.2, bins: int = 24, least: float = 2.0) -> None:
        self.depth, self.trees, self.rate, self.bins, self.least = depth, trees, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        n, width = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(width)]
        # flags, most of the features, are summed by one matrix product; the rest by bins
        flags = np.array([f for f in range(width) if set(np.unique(x[:, f])) == {0, 1}], np.int64)
        for f in flags.tolist():
            self.edges[f] = np.array([0.5])
        on = np.ascontiguousarray(x[:, flags].T, dtype=np.float64)
        others = [f for f in range(width) if f not in set(flags.tolist()) and len(self.edges[f])]
        binned = {f: np.searchsorted(self.edges[f], x[:, f], side="left") for f in others}
        inner, bins = (1 << self.depth) - 1, self.bins + 1
        self.feature = np.zeros((self.trees, inner), np.int64)
        self.cut = np.full((self.trees, inner), np.inf)
        self.leaf = np.zeros((self.trees, inner + 1))
        share = float(np.average(y, weights=weight)) if n else 0.5
        self.base = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        margin, rows = np.full(n, self.base), np.arange(n)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = weight * (y - p), weight * p * (1 - p) + 1e-9
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                at = node - first
                total_g, total_h = (np.bincount(at, v, count)[:, None] for v in (g, h))
                best, where, edge = np.full(count, 1e-6), np.zeros(count, np.int64), np.full(count, np.inf)

                def gains(left_g, left_h):
                    rest_g, rest_h = total_g - left_g, total_h - left_h
                    return left_g**2 / (left_h + self.least) + rest_g**2 / (rest_h + self.least) - total_g**2 / (total_h + self.least)

                def take(gain, feature, cut):
                    better = gain > best
                    best[better], where[better], edge[better] = gain[better], feature[better], cut[better]

                if len(flags):
                    member = np.zeros((n, count))
                    member[rows, at] = g
                    right_g = (on @ member).T
                    member[rows, at] = h
                    gain = gains(total_g - right_g, total_h - (on @ member).T)
                    k = gain.argmax(axis=1)
                    take(gain[np.arange(count), k], flags[k], np.full(count, 0.5))
                for f in others:
                    slot = at * bins + binned[f]
                    gs, hs = (np.bincount(slot, v, count * bins).reshape(count, bins).cumsum(axis=1) for v in (g, h))
                    gain = gains(gs, hs)[:, : len(self.edges[f])]
                    k = gain.argmax(axis=1)
                    take(gain[np.arange(count), k], np.full(count, f), self.edges[f][k])
                self.feature[t, first : first + count] = where
                self.cut[t, first : first + count] = edge
                node = 2 * node + 1 + (x[rows, where[at]] > edge[at])
            leaf = node - inner
            self.leaf[t] = self.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + self.least)
            margin += self.leaf[t, leaf]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.cut[t, node])
            out += self.leaf[t, node - ((1 << self.depth) - 1)]
        return out
