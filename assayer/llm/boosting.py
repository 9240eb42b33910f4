"""Small gradient-boosted trees for binary labels, on binned columns."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class BoostedTrees:
    """Trees of fixed depth in heap order; a node sends values above its cut to the right."""

    rounds: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    penalty: float = 1.0
    start: float = 0.0
    columns: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = sigmoid(margin)
            margin += self._grow(binned, edges, weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6))
        return self

    def _grow(self, binned, edges, gradient, curvature) -> np.ndarray:
        inner = 2**self.depth - 1
        columns, cuts = np.zeros(inner, np.int32), np.full(inner, np.inf)
        node = np.zeros(len(gradient), np.int64)
        for n in range(inner):
            own = np.flatnonzero(node == n)
            best, choice = 1e-9, None
            total_g, total_h = gradient[own].sum(), curvature[own].sum()
            for c, edge in enumerate(edges):
                if not len(edge) or not len(own):
                    continue
                g = np.bincount(binned[own, c], gradient[own], len(edge) + 1).cumsum()[:-1]
                h = np.bincount(binned[own, c], curvature[own], len(edge) + 1).cumsum()[:-1]
                gain = (
                    g**2 / (h + self.penalty)
                    + (total_g - g) ** 2 / (total_h - h + self.penalty)
                    - total_g**2 / (total_h + self.penalty)
                )
                at = int(gain.argmax())
                if gain[at] > best:
                    best, choice = gain[at], (c, at)
            right = np.zeros(len(own), bool)
            if choice:
                columns[n], cuts[n] = choice[0], edges[choice[0]][choice[1]]
                right = binned[own, choice[0]] > choice[1]
            node[own] = 2 * n + 1 + right
        leaf = node - inner
        g, h = (np.bincount(leaf, v, inner + 1) for v in (gradient, curvature))
        values = self.rate * g / (h + self.penalty)
        self.columns.append(columns)
        self.cuts.append(cuts)
        self.leaves.append(values)
        return values[leaf]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        margin, rows = np.full(len(x), self.start), np.arange(len(x))
        for columns, cuts, leaves in zip(self.columns, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, columns[node]] > cuts[node])
            margin += leaves[node - len(columns)]
        return sigmoid(margin)
