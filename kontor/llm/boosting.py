"""Gradient boosted trees for a few thousand rows (a bounded fit on the driver).

Logistic loss, second-order gains, splits between quantiles of each feature;
probabilities by Platt scaling on rows that grew no tree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 40
DEPTH = 3
RATE = 0.2
CUTS = 16
L2 = 1.0


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int) -> tuple:
    """(feature, cut, left, right), or (value,) for a leaf."""
    total_g, total_h = g.sum(), h.sum()
    best = (1e-6, None)
    if depth:
        for j, c in enumerate(cuts):
            low = x[:, j, None] <= c
            left_g, left_h = (g[:, None] * low).sum(0), (h[:, None] * low).sum(0)
            gain = (
                left_g**2 / (left_h + L2)
                + (total_g - left_g) ** 2 / (total_h - left_h + L2)
                - total_g**2 / (total_h + L2)
            )
            if len(c) and gain.max() > best[0]:
                best = (gain.max(), (j, float(c[gain.argmax()])))
    if best[1] is None:
        return (-total_g / (total_h + L2) * RATE,)
    j, cut = best[1]
    low = x[:, j] <= cut
    return (j, cut, _grow(x[low], g[low], h[low], cuts, depth - 1), _grow(x[~low], g[~low], h[~low], cuts, depth - 1))


def _leaf(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    low = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[low], out[~low] = _leaf(tree[2], x[low]), _leaf(tree[3], x[~low])
    return out


@dataclass(frozen=True)
class Boosted:
    trees: tuple
    base: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((_leaf(t, x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.offset)


def fit(x: np.ndarray, y: np.ndarray) -> Boosted:
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 1)[:-1])) for j in range(x.shape[1])]
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base, z, trees = float(np.log(rate / (1 - rate))), np.full(len(y), np.log(rate / (1 - rate))), []
    for _ in range(ROUNDS):
        p = _sigmoid(z)
        tree = _grow(x, p - y, p * (1 - p), cuts, DEPTH)
        trees.append(tree)
        z = z + _leaf(tree, x)
    return Boosted(tuple(trees), base)


def calibrated(model: Boosted, x: np.ndarray, y: np.ndarray) -> Boosted:
    """Platt scaling: slope and offset of the margin, smoothed targets, Newton steps."""
    m, pos, neg = model.margin(x), y.sum(), (1 - y).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, w = np.stack([m, np.ones(len(m))], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(a @ w)
        hessian = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hessian, a.T @ (target - p)), -2, 2)
    return Boosted(model.trees, model.base, float(w[0]), float(w[1]))
