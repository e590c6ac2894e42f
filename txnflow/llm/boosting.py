"""Histogram gradient-boosted trees for a binary label, flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth: ``feature`` and ``threshold`` hold the inner nodes of each tree level by
    level, ``leaf`` the values at the bottom.  A row goes right if its feature is above the threshold."""

    base: float
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2^depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each row: all rows walk down a tree at once."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(leaf) > 1 and node.size and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 120,
    depth: int = 4,
    rate: float = 0.1,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 2.0,
) -> Trees:
    """Fit to rows x (numbers) with labels y (0 to 1).  ``least`` is the smallest sum of second derivatives of a child."""
    n, width = x.shape
    rate0 = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(rate0 / (1 - rate0)))
    inner, bottom = 2**depth - 1, 2**depth
    model = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, bottom)))
    if n == 0 or y.min() == y.max():
        return model
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)  # x <= edge: up to it
    total = np.full(n, base)
    grown = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, curve = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            best = np.full(count, 1e-9)
            for j in range(width):
                cells = at * bins + binned[:, j]
                g = np.bincount(cells, gradient, count * bins).reshape(count, bins).cumsum(1)
                h = np.bincount(cells, curve, count * bins).reshape(count, bins).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                gain[(h < least) | (h_all - h < least)] = 0
                gain[:, len(edges[j]) :] = 0
                cut = gain.argmax(1)
                value = gain[np.arange(count), cut]
                better = np.flatnonzero(value > best)
                best[better] = value[better]
                feature[first + better] = j
                threshold[first + better] = edges[j][cut[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, gradient, bottom) / (np.bincount(at, curve, bottom) + ridge)
        total += leaf[at]
        grown.append((feature, threshold, leaf))
    return Trees(base, *(np.stack(part) for part in zip(*grown, strict=True)))
