"""Gradient-boosted trees for a yes/no label, kept as flat numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Trees:
    """Node i of the flat arrays sends a row left if its feature is at most the threshold; a
    leaf points to itself. ``roots`` has the first node of each tree."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        for _ in range(self.depth):
            below = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        return _sigmoid(self.base + self.value[at].sum(axis=1))


def _grow(nodes, bins, edges, g, h, rows, depth, low, high, monotone, rule):
    """Adds the node for ``rows`` and those below it; returns its number.

    ``low`` and ``high`` bound the values of all leaves below. A split on a constrained feature
    must order the values of its sides, and its middle bounds the sides from then on.
    """
    node = len(nodes)
    weight = lambda gs, hs: float(np.clip(-gs / (hs + rule["l2"]), low, high))
    total_g, total_h = g[rows].sum(), h[rows].sum()
    nodes.append([0, np.inf, node, node, rule["rate"] * weight(total_g, total_h)])
    if depth == 0 or len(rows) < 2 * rule["leaf"]:
        return node
    gain_of = lambda gs, hs, w: -(gs * w + 0.5 * (hs + rule["l2"]) * w * w)
    whole = gain_of(total_g, total_h, weight(total_g, total_h))
    best = (1e-6, None)
    for f, cuts in enumerate(edges):
        if not len(cuts):
            continue
        size = len(cuts) + 1
        column = bins[rows, f]
        n = np.cumsum(np.bincount(column, minlength=size))[:-1]
        gl = np.cumsum(np.bincount(column, g[rows], size))[:-1]
        hl = np.cumsum(np.bincount(column, h[rows], size))[:-1]
        gr, hr = total_g - gl, total_h - hl
        wl = np.clip(-gl / (hl + rule["l2"]), low, high)
        wr = np.clip(-gr / (hr + rule["l2"]), low, high)
        gain = gain_of(gl, hl, wl) + gain_of(gr, hr, wr) - whole
        allowed = (n >= rule["leaf"]) & (len(rows) - n >= rule["leaf"])
        allowed &= monotone[f] * (wr - wl) >= 0
        gain = np.where(allowed, gain, -np.inf)
        cut = int(gain.argmax())
        if gain[cut] > best[0]:
            best = (gain[cut], (f, cut, wl[cut], wr[cut]))
    if best[1] is None:
        return node
    f, cut, wl, wr = best[1]
    middle = (wl + wr) / 2
    bounds = ((low, high), (low, high))
    if monotone[f] > 0:
        bounds = ((low, middle), (middle, high))
    elif monotone[f] < 0:
        bounds = ((middle, high), (low, middle))
    below = bins[rows, f] <= cut
    sides = [
        _grow(nodes, bins, edges, g, h, part, depth - 1, *limits, monotone, rule)
        for part, limits in zip((rows[below], rows[~below]), bounds, strict=True)
    ]
    nodes[node] = [f, edges[f][cut], *sides, 0.0]
    return node


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    monotone: list[int],
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    leaf: int = 10,
    l2: float = 1.0,
    cuts: int = 64,
) -> Trees:
    """Newton boosting of the logistic loss over quantile bins.

    ``monotone`` has +1, -1 or 0 for each feature: the score may only rise, only fall, or move
    freely with it. Without rows, or with one label only, the score is constant.
    """
    rate_of_one = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate_of_one / (1 - rate_of_one)))
    roots, nodes = [], []
    if len(y) and 0 < y.sum() < len(y):
        marks = np.linspace(0, 1, cuts + 1)[1:-1]
        edges = [np.unique(np.quantile(x[:, f], marks, method="lower")) for f in range(x.shape[1])]
        bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
        total = np.full(len(y), base)
        rule = {"rate": rate, "leaf": leaf, "l2": l2}
        for _ in range(trees):
            p = _sigmoid(total)
            root = len(nodes)
            _grow(
                nodes, bins, edges, p - y, np.maximum(p * (1 - p), 1e-9), np.arange(len(y)),
                depth, -np.inf, np.inf, monotone, rule,
            )
            roots.append(root)
            flat = _flat(base, [root], nodes, depth)
            at = np.full(len(y), root)
            for _ in range(depth):
                below = x[np.arange(len(y)), flat.feature[at]] <= flat.threshold[at]
                at = np.where(below, flat.left[at], flat.right[at])
            total += flat.value[at]
    if not nodes:
        nodes, roots = [[0, np.inf, 0, 0, 0.0]], [0]
    return _flat(base, roots, nodes, depth)


def _flat(base, roots, nodes, depth) -> Trees:
    feature, threshold, left, right, value = zip(*nodes, strict=True)
    return Trees(
        base, np.array(roots), np.array(feature), np.array(threshold), np.array(left),
        np.array(right), np.array(value), depth,
    )
