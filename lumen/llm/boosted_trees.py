"""Gradient-boosted trees for a yes/no label, fitted on a small matrix and applied inside tasks.

The trees correct a prior log-odds that each row brings along.
"""

from __future__ import annotations

import numpy as np

TREES, DEPTH, RATE, BINS = 40, 3, 0.15, 32
#: Added to a leaf's curvature.
RIDGE = 20.0


class BoostedTrees:
    """Complete binary trees of depth ``DEPTH``: a row goes right where its feature exceeds the threshold."""

    def __init__(self, features: np.ndarray, thresholds: np.ndarray, leaves: np.ndarray):
        self.features, self.thresholds, self.leaves = features, thresholds, leaves

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, prior: np.ndarray) -> BoostedTrees:
        rows, columns = x.shape
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(columns)]
        binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
        logit, inner = prior.astype(float), 2**DEPTH - 1
        features, thresholds = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf)
        leaves = np.zeros((TREES, 2**DEPTH))
        for tree in range(TREES):
            p = 1 / (1 + np.exp(-logit))
            gradient, curvature, node = y - p, p * (1 - p), np.zeros(rows, np.int64)
            for level in range(DEPTH):
                first, width = 2**level - 1, 2**level
                cell = ((node - first)[:, None] * columns + np.arange(columns)) * BINS + binned
                g, h = (np.bincount(cell.ravel(), np.repeat(v, columns), width * columns * BINS).reshape(width, columns, BINS)
                        for v in (gradient, curvature))
                gl, hl = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
                gt, ht = g.sum(axis=2)[:, :, None], h.sum(axis=2)[:, :, None]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                for k in range(width):
                    f, b = np.unravel_index(np.argmax(gain[k]), gain[k].shape)
                    if gain[k, f, b] > 1e-9 and b < len(cuts[f]):
                        features[tree, first + k], thresholds[tree, first + k] = f, cuts[f][b]
                node = cls.below(x, node, features[tree], thresholds[tree])
            leaf = node - inner
            sums = [np.bincount(leaf, v, 2**DEPTH) for v in (gradient, curvature)]
            leaves[tree] = RATE * sums[0] / (sums[1] + RIDGE)
            logit = logit + leaves[tree][leaf]
        return cls(features, thresholds, leaves)

    @staticmethod
    def below(x: np.ndarray, node: np.ndarray, features: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
        return 2 * node + 1 + (x[np.arange(len(x)), features[node]] > thresholds[node])

    def logits(self, x: np.ndarray, prior: np.ndarray) -> np.ndarray:
        out = prior.astype(float)
        for features, thresholds, leaves in zip(self.features, self.thresholds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = self.below(x, node, features, thresholds)
            out += leaves[node - len(features)]
        return out
