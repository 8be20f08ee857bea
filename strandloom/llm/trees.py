"""Small histogram tree learners in numpy: gradient-boosted trees, a random forest, isotonic regression.

Trees are complete binary trees of a fixed depth, held as arrays, so that scoring is a few array look-ups a level and a
model is a few kilobytes that a task's closure carries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Tree:
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while at.size and at[0] < len(self.feature):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.threshold[at])
        return self.leaf[at - len(self.feature)]


def cuts_of(x: np.ndarray) -> list[np.ndarray]:
    """Up to BINS - 1 ascending thresholds of each feature."""
    return [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.empty(0) for c in x.T]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1).astype(np.int64)


def grow(b: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float,
         rng: np.random.Generator | None = None, tries: int | None = None) -> Tree:
    """One tree for gradients g and weights h; with rng each level looks at `tries` drawn features only."""
    n, f = b.shape
    inner = 2**depth - 1
    feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
    for level in range(depth):
        base, width = 2**level - 1, 2**level
        best = np.full(width, 1e-9)
        split = np.zeros(width, np.int64)
        chosen = rng.choice(f, tries, replace=False) if rng is not None else range(f)
        for j in chosen:
            if not len(cuts[j]):
                continue
            key, size = (node - base) * BINS + b[:, j], width * BINS
            cg = np.bincount(key, g, size).reshape(width, BINS).cumsum(1)
            ch = np.bincount(key, h, size).reshape(width, BINS).cumsum(1)
            tg, th = cg[:, -1:], ch[:, -1:]
            gain = cg**2 / (ch + ridge) + (tg - cg) ** 2 / (th - ch + ridge) - tg**2 / (th + ridge)
            gain[(ch < least) | (th - ch < least)] = 0
            gain[:, len(cuts[j]) :] = 0
            at = gain.argmax(1)
            top = gain[np.arange(width), at]
            better = top > best
            best[better], split[better] = top[better], at[better]
            feature[base : base + width][better] = j
            threshold[base : base + width][better] = cuts[j][at[better]]
        at = node - base
        right = (best[at] > 1e-9) & (b[np.arange(n), feature[node]] > split[at])
        node = 2 * node + 1 + right
    leaf = node - inner
    return Tree(feature, threshold, np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge))


@dataclass
class Boosted:
    start: float
    rate: float
    trees: list[Tree]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, ridge: float = 1.0, least: float = 2.0) -> Boosted:
    """Boosted trees for the logistic loss; without rows or with one class only, a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Boosted(float(np.log(share / (1 - share))), rate, [])
    if not len(y) or y.min() == y.max():
        return model
    cuts = cuts_of(x)
    b, raw = binned(x, cuts), np.full(len(y), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        tree = grow(b, cuts, y - p, np.maximum(p * (1 - p), 1e-6), depth, ridge, least)
        model.trees.append(tree)
        raw += rate * tree.predict(x)
    return model


@dataclass
class Forest:
    trees: list[Tree]
    share: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sum((t.predict(x) for t in self.trees), np.zeros(len(x))) / len(self.trees) if self.trees else np.full(len(x), self.share)


def forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 8, seed: int = 0) -> Forest:
    """Bagged trees with drawn features at each level; leaf values are class shares."""
    share = float((y.sum() + 0.5) / (len(y) + 1))
    if not len(y) or y.min() == y.max():
        return Forest([], share)
    rng, cuts = np.random.default_rng(seed), cuts_of(x)
    b, tries, grown = binned(x, cuts), max(1, round(2 * x.shape[1] ** 0.5)), []
    for _ in range(trees):
        h = rng.poisson(1.0, len(y)).astype(float)  # a bootstrap as weights
        tree = grow(b, cuts, h * (y - share), h, depth, 1e-3, 2.0, rng, min(tries, x.shape[1]))
        tree.leaf = np.clip(tree.leaf + share, 0, 1)
        grown.append(tree)
    return Forest(grown, share)


@dataclass
class Isotonic:
    at: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.at, self.value) if len(self.at) else np.clip(x, 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; between the pools' means the value is interpolated."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b in zip(x[order], y[order], strict=True):
        pools.append([a, b, 1.0])
        while len(pools) > 1 and (pools[-2][1] >= pools[-1][1] or pools[-2][0] == pools[-1][0]):
            a2, b2, n2 = pools.pop()
            a1, b1, n1 = pools[-1]
            pools[-1] = [(a1 * n1 + a2 * n2) / (n1 + n2), (b1 * n1 + b2 * n2) / (n1 + n2), n1 + n2]
    p = np.array(pools).reshape(-1, 3)
    return Isotonic(p[:, 0], p[:, 1])
