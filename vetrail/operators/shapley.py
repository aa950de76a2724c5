"""Exact Shapley values of boosted trees, with the covers of the nodes as the background.

A leaf is reached by the rows that fit an interval of each feature on its path. Of a feature that is not known, the
share of the cover that goes the leaf's way stands in. So a leaf's game is a product: for known features 1 or 0,
for the others their share. The Shapley value of a feature depends only on which of the leaf's features a row fits;
for u features there are 2^u patterns, whose values are worked out once per leaf, and a row looks its pattern up.
Values of leaves and trees add up, and with the expected margin they give the row's margin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from vetrail.operators.boost import BoostedTrees, Tree

#: Rows explained at a time, and pattern values of one tree's leaves held at a time.
_ROWS, _VALUES = 8192, 4_000_000


@dataclass
class Leaves:
    """Leaves with the same number of features on their paths: (leaves, features) arrays, and their values."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def leaf_paths(tree: Tree, thresholds: np.ndarray) -> list[Leaves]:
    """The leaves of a tree, grouped by how many features tell them apart from the root."""
    found: dict[int, list[tuple]] = {}
    open_: list[tuple[int, dict]] = [(0, {})]
    while open_:
        node, path = open_.pop()
        f = int(tree.feature[node])
        if f < 0:
            found.setdefault(len(path), []).append((path, tree.value[node]))
            continue
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        cut = thresholds[node]
        sides = ((2 * node + 1, low, min(high, cut)), (2 * node + 2, max(low, cut), high))
        for child, a, b in sides:
            open_.append((child, path | {f: (a, b, share * tree.cover[child] / tree.cover[node])}))
    out = []
    for n, leaves in found.items():
        table = np.array([[(f, *path[f]) for f in sorted(path)] for path, _ in leaves]).reshape(len(leaves), n, 4)
        value = np.array([v for _, v in leaves])
        out.append(Leaves(table[:, :, 0].astype(int), table[:, :, 1], table[:, :, 2], table[:, :, 3], value))
    return out


def pattern_values(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Shapley values (leaves, patterns, features); bit j of a pattern says that feature j fits the leaf."""
    leaves, n = share.shape
    fits = (np.arange(1 << n)[:, None] >> np.arange(n) & 1).astype(np.float64)
    weight = np.array([math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) for k in range(n)])
    out = np.zeros((leaves, 1 << n, n))
    for i in range(n):
        # Coefficient k: the sum over all sets of k other features of the product of the game.
        sets = np.zeros((leaves, 1 << n, n))
        sets[:, :, 0] = 1
        for j in range(n):
            if j != i:
                known = sets * fits[None, :, j, None]
                sets = sets * share[:, None, j, None]
                sets[:, :, 1:] += known[:, :, :-1]
        out[:, :, i] = value[:, None] * (fits[None, :, i] - share[:, None, i]) * (sets @ weight)
    return out


def _parts(leaves: Leaves) -> Iterator[Leaves]:
    n = leaves.share.shape[1]
    step = max(1, _VALUES // ((1 << n) * max(n, 1)))
    for s in range(0, len(leaves.value), step):
        at = slice(s, s + step)
        yield Leaves(leaves.feature[at], leaves.low[at], leaves.high[at], leaves.share[at], leaves.value[at])


def shapley_values(model: BoostedTrees, x: np.ndarray) -> np.ndarray:
    """Shapley values in margin space (rows, features); with ``model.expected`` a row's add up to its margin."""
    columns, out = np.ascontiguousarray(x.T), np.zeros(x.shape[::-1])
    for tree, thresholds in zip(model.trees, model.thresholds):
        for group in leaf_paths(tree, thresholds):
            n = group.share.shape[1]
            if not n:
                continue
            small = np.min_scalar_type((1 << n) - 1)
            for leaves in _parts(group):
                # Feature by feature: what a row's pattern is looked up in lies side by side.
                values = np.ascontiguousarray(pattern_values(leaves.share, leaves.value).transpose(0, 2, 1))
                for s in range(0, len(x), _ROWS):
                    rows, found = columns[:, s : s + _ROWS], out[:, s : s + _ROWS]
                    for k, features in enumerate(leaves.feature):
                        pattern = np.zeros(rows.shape[1], small)
                        for j, f in enumerate(features):
                            fits = (rows[f] >= leaves.low[k, j]) & (rows[f] < leaves.high[k, j])
                            pattern |= fits.astype(small) << small.type(j)
                        pattern = pattern.astype(np.intp)
                        for j, f in enumerate(features):
                            found[f] += values[k, j].take(pattern)
    return np.ascontiguousarray(out.T)
