"""Histogram gradient-boosted trees for a 0/1 label, in numpy.

Features are cut into quantile bins; each level of a tree sums gradients and
Hessians per (node, feature, bin) with one ``bincount``.  A fitted model is
flat arrays of complete binary trees, walked for all rows and trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Node i of a tree has the children 2i + 1 (feature <= cut) and 2i + 2; leaves point at themselves."""

    feature: np.ndarray   # trees x nodes
    cut: np.ndarray       # trees x nodes; +inf sends every row left
    value: np.ndarray     # trees x leaves, in the order of the last level
    bias: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves of each row of ``x`` (rows x features)."""
        trees = np.arange(len(self.feature))[None, :]
        rows = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
        return self.bias + self.value[trees, node - (2 ** self.depth - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Distinct quantiles of each feature; a value goes to the bin of the first edge at or above it."""
    q = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, f], q)) for f in range(x.shape[1])]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
        penalty: float = 1.0, least: float = 3.0) -> Trees:
    """Trees for the labels ``y`` (0 or 1).  Equal labels give a constant; no rows give 1/2."""
    n, features = x.shape
    nodes, leaves = 2 ** depth - 1, 2 ** depth
    p = (y.sum() + 1) / (n + 2)
    out = Trees(np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf), np.zeros((trees, leaves)),
                float(np.log(p / (1 - p))), depth)
    if n == 0 or y.min() == y.max():
        return out
    edges = bin_edges(x, bins)
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    slot = binned + np.arange(features) * bins
    margin = np.full(n, out.bias)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            key = ((node - first)[:, None] * (features * bins) + slot).ravel()
            shape = (width, features, bins)
            size = width * features * bins
            gs = np.bincount(key, np.repeat(g, features), size).reshape(shape).cumsum(axis=2)
            hs = np.bincount(key, np.repeat(h, features), size).reshape(shape).cumsum(axis=2)
            ns = np.bincount(key, minlength=size).reshape(shape).cumsum(axis=2)
            ga, ha, na = gs[:, :, -1:], hs[:, :, -1:], ns[:, :, -1:]
            gain = gs ** 2 / (hs + penalty) + (ga - gs) ** 2 / (ha - hs + penalty) - ga ** 2 / (ha + penalty)
            gain[(ns < least) | (na - ns < least)] = 0
            flat = gain.reshape(width, -1)
            best = flat.argmax(axis=1)
            for i in range(width):
                f, b = divmod(int(best[i]), bins)
                if flat[i, best[i]] > 1e-9 and b < len(edges[f]):
                    out.feature[t, first + i], out.cut[t, first + i] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), out.feature[t, node]] > out.cut[t, node])
        leaf = node - nodes
        gl, hl = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
        out.value[t] = -rate * gl / (hl + penalty)
        margin += out.value[t, leaf]
    return out
