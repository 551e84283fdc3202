"""A generalised additive model with pairwise interactions, grown by cyclic boosting of shallow trees.

Each feature is cut into quantile bins, and the model is a table of log-odds for each feature's bins and for the bins of some pairs of
features. Boosting visits the tables in turn; a visit fits a shallow tree to the gradient, summed by bin, and adds
its steps to the table. Scoring looks bins up and adds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass(frozen=True)
class Boosting:
    bins: int = 48
    pair_bins: int = 12
    rounds: int = 150
    pair_rounds: int = 60
    pairs: int = 8
    rate: float = 0.15
    depth: int = 2
    # Least sum of hessians (row weight times p (1 - p)) in a leaf, and the ridge on its value.
    least: float = 2.0
    ridge: float = 1.0


@dataclass
class Additive:
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, k], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.pair_edges)]
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[coarse[a], coarse[b]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.log_odds(x))


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def quantile_edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between bins of about equal size; a value equal to a cut lies above it."""
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _best_cut(g: np.ndarray, h: np.ndarray, how: Boosting) -> tuple[float, int]:
    """Gain and place of the best cut of a line of bins (0: none)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + how.ridge) + right_g**2 / (right_h + how.ridge) - g.sum() ** 2 / (h.sum() + how.ridge)
    gain = np.where((left_h >= how.least) & (right_h >= how.least), gain, 0.0)
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) and gain.max() > 1e-12 else (0.0, 0)


def tree_steps(g: np.ndarray, h: np.ndarray, how: Boosting, depth: int | None = None) -> np.ndarray:
    """Newton steps of a shallow tree over a line or a grid of bins with these gradient and hessian sums."""
    depth = how.depth if depth is None else depth
    cuts = [_best_cut(g.sum(axis=tuple(a for a in range(g.ndim) if a != k)), h.sum(axis=tuple(a for a in range(g.ndim) if a != k)), how) for k in range(g.ndim)]
    axis = max(range(g.ndim), key=lambda k: cuts[k][0])
    place = cuts[axis][1]
    if depth == 0 or place == 0:
        return np.full(g.shape, g.sum() / (h.sum() + how.ridge))
    parts = zip(np.split(g, [place], axis), np.split(h, [place], axis), strict=True)
    return np.concatenate([tree_steps(a, b, how, depth - 1) for a, b in parts], axis)


def _gain(g: np.ndarray, h: np.ndarray, how: Boosting) -> float:
    """How much of the loss a shallow tree over the grid takes away, beyond what its two lines take."""
    def of(steps: np.ndarray) -> float:
        return float((steps * g - steps**2 * h / 2).sum())

    lines = [tree_steps(g.sum(axis=k), h.sum(axis=k), how) for k in (1, 0)]
    grid = tree_steps(g, h, how)
    return of(grid) - max(of(np.broadcast_to(lines[0][:, None], g.shape)), of(np.broadcast_to(lines[1][None, :], g.shape)))


def fit(x: np.ndarray, y: np.ndarray, how: Boosting = Boosting()) -> Additive:
    """The model of labels 0 and 1; without rows, or without columns, it is the smoothed log-odds of the labels."""
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if not len(x):
        return Additive(base, [], [])
    columns = range(x.shape[1])
    edges = [quantile_edges(x[:, k], how.bins) for k in columns]
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]
    model = Additive(base, edges, [np.zeros(len(e) + 1) for e in edges])
    f = np.full(len(x), base)
    for _ in range(how.rounds):
        for k in columns:
            p = _sigmoid(f)
            size = len(model.tables[k])
            steps = how.rate * tree_steps(np.bincount(bins[k], y - p, size), np.bincount(bins[k], p * (1 - p), size), how)
            model.tables[k] += steps
            f += steps[bins[k]]
    model.pair_edges = [quantile_edges(x[:, k], how.pair_bins) for k in columns]
    coarse = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def grid(a: int, b: int, weights: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * sizes[b] + coarse[b], weights, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    p = _sigmoid(f)
    gains = {(a, b): _gain(grid(a, b, y - p), grid(a, b, p * (1 - p)), how) for a in columns for b in range(a)}
    model.pairs = [pair for pair in sorted(gains, key=lambda k: (-gains[k], k))[: how.pairs] if gains[pair] > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(how.pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            p = _sigmoid(f)
            steps = how.rate * tree_steps(grid(a, b, y - p), grid(a, b, p * (1 - p)), how)
            table += steps
            f += steps[coarse[a], coarse[b]]
    return model
