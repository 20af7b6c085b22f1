"""Gradient-boosted trees in numpy, for training on a bounded sample and scoring anywhere.

Training bins each feature at quantiles and grows trees of a fixed depth on histograms of the
logistic loss. A finished model is five flat arrays (feature, threshold, left, right, value) in
which all trees' nodes follow each other, so scoring a batch is a few array lookups per level.
A feature may be constrained to never raise (-1) or never lower (+1) the score: a split against
that direction is refused, and the values below an accepted one are bounded by the midpoint of
its two sides, so the constraint holds for the whole model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    feature: np.ndarray  # -1 at a leaf
    threshold: np.ndarray  # left where x <= threshold
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                low = x[rows, np.maximum(f, 0)] <= self.threshold[node]
                node = np.where(inner, np.where(low, self.left[node], self.right[node]), node)
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, *, monotone: dict[int, int] | None = None, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: int = 5) -> Trees:
    """Deterministic for the same rows in the same order. One class only gives a constant model."""
    n, width = x.shape
    monotone = monotone or {}
    share = (y.sum() + 1.0) / (n + 2.0)
    margin = np.full(n, np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    binned = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]

    def add(value: float) -> int:
        for k, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", value)):
            nodes[k].append(v)
        return len(nodes["value"]) - 1

    def best(rows: np.ndarray, g: np.ndarray, h: np.ndarray, lower: float, upper: float):
        all_g, all_h = g[rows].sum(), h[rows].sum()
        found = (1e-6, None)
        for f in range(width):
            size = len(cuts[f]) + 1
            if size < 2:
                continue
            at = binned[f][rows]
            gl = np.cumsum(np.bincount(at, g[rows], size))[:-1]
            hl = np.cumsum(np.bincount(at, h[rows], size))[:-1]
            nl = np.cumsum(np.bincount(at, minlength=size))[:-1]
            vl, vr = np.clip(-gl / (hl + l2), lower, upper), np.clip(-(all_g - gl) / (all_h - hl + l2), lower, upper)
            gain = gl**2 / (hl + l2) + (all_g - gl) ** 2 / (all_h - hl + l2) - all_g**2 / (all_h + l2)
            gain[(nl < least) | (len(rows) - nl < least)] = -1
            if way := monotone.get(f, 0):
                gain[(vr - vl) * way < 0] = -1
            k = int(np.argmax(gain))
            if gain[k] > found[0]:
                found = (gain[k], (f, k, vl[k], vr[k]))
        return found[1]

    def grow(rows: np.ndarray, g, h, level: int, lower: float, upper: float) -> int:
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), lower, upper))
        node = add(rate * value)
        split = best(rows, g, h, lower, upper) if level and len(rows) >= 2 * least else None
        if split is None:
            margin[rows] += rate * value
            return node
        f, k, vl, vr = split
        way, middle = monotone.get(f, 0), (vl + vr) / 2
        left, right = rows[binned[f][rows] <= k], rows[binned[f][rows] > k]
        bounds = {1: ((lower, middle), (middle, upper)), -1: ((middle, upper), (lower, middle)), 0: ((lower, upper), (lower, upper))}[way]
        nodes["feature"][node], nodes["threshold"][node] = f, float(cuts[f][k])
        nodes["left"][node] = grow(left, g, h, level - 1, *bounds[0])
        nodes["right"][node] = grow(right, g, h, level - 1, *bounds[1])
        return node

    start = float(margin[0]) if n else 0.0
    for _ in range(trees if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), depth, -8.0, 8.0))
    arrays = {k: np.asarray(v, dtype=np.float64 if k in ("threshold", "value") else np.int64) for k, v in nodes.items()}
    return Trees(**arrays, roots=np.asarray(roots, dtype=np.int64), depth=depth, start=start)
