"""Gradient-boosted regression trees on binned dense features, and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Trees:
    """Complete trees of one depth: node k of a tree has children 2k + 1 and 2k + 2."""

    depth: int
    start: float
    features: list[np.ndarray] = field(default_factory=list)
    limits: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.features, self.limits, self.leaves, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - len(f)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.2, bins: int = 48, l2: float = 1.0) -> Trees:
    """Logistic loss; each split is the best of all features and bin borders by second-order gain."""
    prior = float(np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4))
    model = Trees(depth, float(np.log(prior / (1 - prior))))
    borders = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    # zero against more than zero is a split that quantiles of sparse features miss
    borders = [np.unique(np.append(b, 0.0)) for b in borders]
    binned = np.stack([np.searchsorted(b, c, side="left") for b, c in zip(borders, x.T, strict=True)], axis=1)
    width = max(len(b) for b in borders) + 1
    score = np.full(len(x), model.start)
    inner = 2**depth - 1
    for _ in range(rounds):
        p = sigmoid(score)
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(x), dtype=np.int64)
        for level in range(depth):
            first = 2**level - 1
            for k in range(first, first + 2**level):
                rows = np.flatnonzero(node == k)
                if len(rows) < 2:
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                best = 1e-6
                for f, b in enumerate(borders):
                    left_g = np.cumsum(np.bincount(binned[rows, f], g[rows], width))[: len(b)]
                    left_h = np.cumsum(np.bincount(binned[rows, f], h[rows], width))[: len(b)]
                    gain = left_g**2 / (left_h + l2) + (gs - left_g) ** 2 / (hs - left_h + l2) - gs**2 / (hs + l2)
                    j = int(gain.argmax())
                    if gain[j] > best:
                        best, feature[k], limit[k] = gain[j], f, b[j]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > limit[node])
        place = node - inner
        leaf = rate * np.bincount(place, g, 2**depth) / (np.bincount(place, h, 2**depth) + l2)
        score += leaf[place]
        model.features.append(feature)
        model.limits.append(limit)
        model.leaves.append(leaf)
    return model


def fit_isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: knots of the best non-decreasing map from scores to probabilities."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, first score, last score
    for s, t, w in zip(score[order], y[order], weight[order], strict=True):
        blocks.append([float(t), float(w), float(s), float(s)])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            m, w2, _, end = blocks.pop()
            m1, w1, begin, _ = blocks.pop()
            blocks.append([(m1 * w1 + m * w2) / (w1 + w2), w1 + w2, begin, end])
    at = np.array([v for b in blocks for v in (b[2], b[3])])
    to = np.array([b[0] for b in blocks for _ in range(2)])
    return at, to
