"""Gradient-boosted trees for a yes-or-no target, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: split feature and bin by inner node, value by leaf.

    The first ``len(edges)`` features are numbers and are binned, the others are 0 or 1.
    """

    edges: list[np.ndarray]
    base: float
    depth: int
    splits: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = x.astype(np.uint8)
        for j, edge in enumerate(self.edges):
            out[:, j] = np.searchsorted(edge, x[:, j], side="right")
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for (feature, cut), value in zip(self.splits, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out


def fit(
    x: np.ndarray,
    y: np.ndarray,
    numbers: int,
    rounds: int = 80,
    depth: int = 4,
    rate: float = 0.3,
    most_bins: int = 32,
) -> Trees:
    """Newton steps on the logistic loss; every split is the best of all bins of all features.

    The first ``numbers`` features are binned by quantiles, the others are 0 or 1.
    """
    edges = [
        np.unique(np.quantile(x[:, j], np.linspace(0, 1, most_bins)[1:-1])) for j in range(numbers)
    ]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    trees = Trees(edges, float(np.log(share / (1 - share))), depth)
    bins = trees.binned(x)
    flags = np.ascontiguousarray(bins[:, numbers:].T, dtype=np.float32)
    width = most_bins + 1
    logits = np.full(len(x), trees.base)

    def gains(g, h, all_g, all_h):
        rest_g, rest_h = all_g - g, all_h - h
        return g**2 / (h + 1) + rest_g**2 / (rest_h + 1) - all_g**2 / (all_h + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logits))
        grad, hess = p - y, p * (1 - p) + 1e-6
        feature = np.zeros(2**depth - 1, np.int64)
        cut = np.full(2**depth - 1, width)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            all_g, all_h = np.bincount(local, grad, count), np.bincount(local, hess, count)
            best, at = np.full(count, 1e-6), slice(first, first + count)
            for j in range(numbers):
                slot = local * width + bins[:, j]
                g = np.bincount(slot, grad, count * width).reshape(count, width).cumsum(1)
                h = np.bincount(slot, hess, count * width).reshape(count, width).cumsum(1)
                gain = gains(g, h, all_g[:, None], all_h[:, None])
                split = gain.argmax(1)
                found = gain[np.arange(count), split]
                better = found > best
                best[better] = found[better]
                feature[at][better], cut[at][better] = j, split[better]
            if len(flags):
                member = np.zeros((len(x), count), np.float32)
                member[np.arange(len(x)), local] = 1
                set_g = flags @ (member * grad[:, None].astype(np.float32))
                set_h = flags @ (member * hess[:, None].astype(np.float32))
                gain = gains(set_g, set_h, all_g, all_h)
                which = gain.argmax(0)
                found = gain[which, np.arange(count)]
                better = found > best
                feature[at][better], cut[at][better] = numbers + which[better], 0
            node = 2 * node + 1 + (bins[np.arange(len(x)), feature[node]] > cut[node])
        leaf = node - (2**depth - 1)
        value = -rate * np.bincount(leaf, grad, 2**depth) / (np.bincount(leaf, hess, 2**depth) + 1)
        logits += value[leaf]
        trees.splits.append((feature, cut))
        trees.leaves.append(value)
    return trees
