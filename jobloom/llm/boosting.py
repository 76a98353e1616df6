"""Gradient-boosted trees for two classes, with logistic loss, for small feature tables."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: at each inner node a feature and a cut, at each leaf a step of the log-odds."""

    base: float
    depth: int
    features: list[list[int]] = field(default_factory=list)
    cuts: list[list[float]] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            total += leaves[self._leaf(x, features, cuts)]
        return 1 / (1 + np.exp(-total))

    def _leaf(self, x: np.ndarray, features: list[int], cuts: list[float]) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        f, c = np.array(features), np.array(cuts)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), f[node]] > c[node])
        return node - len(features)


def _best_cut(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> tuple[int, float]:
    best, found = 1e-9, (0, np.inf)
    total, mass = gradient.sum(), weight.sum() + 1.0
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        value = x[order, f]
        left, under = np.cumsum(gradient[order])[:-1], np.cumsum(weight[order])[:-1] + 1.0
        gain = left**2 / under + (total - left) ** 2 / (mass - under + 1.0) - total**2 / mass
        gain[value[1:] <= value[:-1]] = 0  # no cut between equal values
        if len(gain) and gain.max() > best:
            k = int(gain.argmax())
            best, found = gain[k], (f, float(value[k] + value[k + 1]) / 2)
    return found


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.25) -> Trees:
    """Boost trees on features ``x`` and labels ``y`` (0 or 1); Newton steps at the leaves."""
    share = y.mean().clip(1e-3, 1 - 1e-3)
    model = Trees(float(np.log(share / (1 - share))), depth)
    total = np.full(len(y), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        features, cuts = [], []
        node = np.zeros(len(y), np.int64)
        for at in range(2**depth - 1):
            here = node == at
            f, c = _best_cut(x[here], gradient[here], weight[here]) if here.sum() > 1 else (0, np.inf)
            features.append(f)
            cuts.append(c)
            node[here] = 2 * at + 1 + (x[here, f] > c)
        leaf = node - len(features)
        size = 2**depth
        steps = rate * np.bincount(leaf, gradient, size) / (np.bincount(leaf, weight, size) + 1.0)
        model.features.append(features)
        model.cuts.append(cuts)
        model.leaves.append(steps)
        total += steps[leaf]
    return model
