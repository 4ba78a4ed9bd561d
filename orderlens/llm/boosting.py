"""Gradient-boosted trees in numpy: histogram splits, logistic loss, monotonic
constraints, and a flat node table for vectorised scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class FlatTrees:
    """Nodes of all trees in arrays.  A leaf points to itself; ``depth`` steps
    from the roots reach the leaves of every tree at once."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for every row of x."""
        out = np.empty(len(x))
        for i in range(0, len(x), 8192):
            rows = x[i:i + 8192]
            node = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
            at = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                low = rows[at, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            out[i:i + 8192] = 1 / (1 + np.exp(-(self.start + self.value[node].sum(axis=1))))
        return out


@dataclass
class _Nodes:
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self) -> int:
        n = len(self.value)
        for column, v in ((self.feature, 0), (self.threshold, 0.0), (self.left, n), (self.right, n), (self.value, 0.0)):
            column.append(v)
        return n


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.2,
        bins: int = 64, ridge: float = 1.0, least: int = 5) -> FlatTrees:
    """Boost ``trees`` trees on rows x and classes y (0/1).

    ``monotone`` holds -1, 0 or 1 a feature: the score may only fall, move
    freely or only rise with it.  A split against the direction is refused, and
    the middle of its children's values bounds all that grows below them."""
    n, features = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features)]
    code = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(features)], axis=1)
    rate_of_ones = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin, nodes, roots = np.full(n, start), _Nodes(), []

    def weight(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return -g / (h + ridge)

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, level: int, low: float, high: float) -> int:
        me = nodes.add()
        g, h = grad[rows].sum(), hess[rows].sum()
        value = float(np.clip(weight(g, h), low, high))
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * least:
            for f in range(features):
                size = len(cuts[f]) + 1
                if size < 2:
                    continue
                c = code[rows, f]
                gl = np.cumsum(np.bincount(c, grad[rows], size))[:-1]
                hl = np.cumsum(np.bincount(c, hess[rows], size))[:-1]
                nl = np.cumsum(np.bincount(c, minlength=size))[:-1]
                wl, wr = np.clip(weight(gl, hl), low, high), np.clip(weight(g - gl, h - hl), low, high)
                gain = -(gl * wl + (hl + ridge) * wl ** 2 / 2) - ((g - gl) * wr + (h - hl + ridge) * wr ** 2 / 2) \
                    + (g * value + (h + ridge) * value ** 2 / 2)
                ok = (nl >= least) & (len(rows) - nl >= least)
                if monotone[f]:
                    ok &= monotone[f] * (wr - wl) >= 0
                gain = np.where(ok, gain, -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, k, float(wl[k]), float(wr[k])))
        if best[1] is None:
            nodes.value[me] = rate * value
            margin[rows] += rate * value
            return me
        f, k, wl, wr = best[1]
        side = code[rows, f] <= k
        bounds = (low, high, low, high)
        if monotone[f]:
            middle = (wl + wr) / 2
            bounds = (low, middle, middle, high) if monotone[f] > 0 else (middle, high, low, middle)
        nodes.feature[me], nodes.threshold[me] = f, float(cuts[f][k])
        nodes.left[me] = grow(rows[side], grad, hess, level + 1, *bounds[:2])
        nodes.right[me] = grow(rows[~side], grad, hess, level + 1, *bounds[2:])
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf))
    return FlatTrees(np.array(nodes.feature), np.array(nodes.threshold), np.array(nodes.left), np.array(nodes.right),
                     np.array(nodes.value), np.array(roots), depth, start)
