"""Gradient-boosted trees on histograms, kept as flat arrays that numpy walks for many rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64  # of a feature
TREES, DEPTH, RATE = 120, 4, 0.15
PENALTY = 2.0  # on the square of a leaf's value
LEAST_WEIGHT = 2.0  # sum of second derivatives in a leaf
LEAST_GAIN = 1e-3


@dataclass
class Forest:
    """All nodes of all trees in one array each; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray  # to the left if not larger
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # of a leaf
    base: float
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The sum of the leaves that each row ends in: all trees step down one level at a time."""
        if not len(self.roots) or not len(x):
            return np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def cuts_of(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins - 1`` cuts of each column, halfway between neighbouring values, at even counts."""
    out = []
    for column in x.T:
        values, counts = np.unique(column, return_counts=True)
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) >= bins:
            below = np.cumsum(counts)[:-1]
            wanted = np.arange(1, bins) * len(column) / bins
            middle = middle[np.unique(np.minimum(np.searchsorted(below, wanted), len(middle) - 1))]
        out.append(middle)
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Forest:
    """Trees that raise the likelihood of labels ``y`` (0 or 1), each fitted to the gradient so far.

    A level of a tree is grown from one histogram of all its nodes and features. Labels of one kind
    only, or none, give no trees: the score is then the same for every row.
    """
    positive = float(y.sum())
    base = float(np.log((positive + 1) / (len(y) - positive + 1)))
    empty = np.empty(0, np.int64)
    if not 0 < positive < len(y) or not x.shape[1]:
        return Forest(empty, empty, np.empty(0), empty, empty, np.empty(0), base, 0)
    cuts = cuts_of(x)
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], axis=1)
    n, wide = binned.shape
    slots = wide * BINS
    place = binned + np.arange(wide) * BINS
    can_cut = np.zeros((wide, BINS), dtype=bool)
    for f, c in enumerate(cuts):
        can_cut[f, : len(c)] = True
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    margin = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        roots.append(len(nodes))
        at = np.full(n, len(nodes))  # the node of each row
        level = [len(nodes)]
        nodes.append([0, 0.0, roots[-1], roots[-1], 0.0])
        for _ in range(depth):
            first = level[0]
            inside = at >= first
            key = ((at[inside] - first)[:, None] * slots + place[inside]).ravel()
            size = len(level) * slots
            g, h = (
                np.bincount(key, np.repeat(v[inside], wide), minlength=size).reshape(len(level), wide, BINS)
                for v in (gradient, weight)
            )
            g_left, h_left = g.cumsum(axis=2), h.cumsum(axis=2)
            g_all, h_all = g_left[:, :, -1:], h_left[:, :, -1:]
            g_right, h_right = g_all - g_left, h_all - h_left
            gain = g_left**2 / (h_left + PENALTY) + g_right**2 / (h_right + PENALTY) - g_all**2 / (h_all + PENALTY)
            gain[~(can_cut & (h_left >= LEAST_WEIGHT) & (h_right >= LEAST_WEIGHT))] = 0
            best = gain.reshape(len(level), -1).argmax(axis=1)
            grown = []
            for k, node in enumerate(level):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] <= LEAST_GAIN:
                    continue
                rows = np.flatnonzero(at == node)
                child = len(nodes)
                nodes[node][:4] = [f, float(cuts[f][b]), child, child + 1]
                nodes += [[0, 0.0, child, child, 0.0], [0, 0.0, child + 1, child + 1, 0.0]]
                at[rows] = child + (binned[rows, f] > b)
                grown += [child, child + 1]
            if not grown:
                break
            level = grown
        # Rows lie in leaves now.
        leaf = at - roots[-1]
        values = np.bincount(leaf, gradient) / (np.bincount(leaf, weight) + PENALTY) * rate
        for k, v in enumerate(values.tolist()):
            nodes[roots[-1] + k][4] = v
        margin = margin + values[leaf]
    feature, threshold, left, right, value = zip(*nodes)
    whole = [np.array(v, dtype=np.int64) for v in (roots, feature, left, right)]
    return Forest(whole[0], whole[1], np.array(threshold), whole[2], whole[3], np.array(value), base, depth)
