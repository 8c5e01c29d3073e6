"""Regression trees over many small series at once: growing, and exact attribution.

Arrays: C trees or chains, n rows, p features. A tree is complete in heap order: level d has 2^d nodes, a
node that does not split sends all its rows to the left. `x` has shape (C, n, p), or (1, n, p) where all
trees share the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

#: a split must gain more than this part of the tree's sum of squares
LEAST_GAIN = 1e-12
#: gains that differ by less than this part are a tie
TIE = 1e-9


@dataclass
class Trees:
    """Per level: split feature (-1: none), threshold, gain, cover and value of the nodes, node of each row."""

    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    gain: list[np.ndarray] = field(default_factory=list)
    cover: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    node: list[np.ndarray] = field(default_factory=list)

    def predict(self, level: int) -> np.ndarray:
        """(C, n) predictions of the trees cut at a level."""
        return np.take_along_axis(self.value[level], self.node[level], 1)


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every value in its feature (C, n, p), and the values by rank (C, p, n), padded with the last."""
    order = np.sort(x, axis=1)
    new = np.concatenate([np.zeros_like(order[:, :1], dtype=bool), order[:, 1:] > order[:, :-1]], axis=1)
    rank_of_sorted = new.cumsum(axis=1)
    place = x.argsort(axis=1, kind="stable")
    rank = np.empty_like(rank_of_sorted)
    np.put_along_axis(rank, place, rank_of_sorted, 1)
    values = np.repeat(order[:, -1:], x.shape[1], axis=1)
    np.put_along_axis(values, rank_of_sorted, order, 1)
    return rank, values.transpose(0, 2, 1)


def grow(
    x: np.ndarray,
    coded: tuple[np.ndarray, np.ndarray],
    weight: np.ndarray,
    target: np.ndarray,
    depth: int,
    shrink: float = 0.0,
    allowed: Callable[[int], np.ndarray] | None = None,
) -> Trees:
    """Level by level, the split of largest gain G^2 / (H + shrink) of every node of every tree.

    H and G are sums of weight and weighted target; rows of weight 0 only pass through. One histogram by
    (tree, node, feature, value) serves a level, so splits are exact. allowed(level) masks (C, nodes, p).
    Ties go to the first feature and the smallest value.
    """
    rank, values = coded
    (c, n), p, bins = weight.shape, x.shape[2], values.shape[2]
    trees, node = Trees(), np.zeros((c, n), dtype=np.int64)
    rows, ids = np.arange(n)[None, :], np.arange(c)[:, None]
    shared = ids if len(x) == c else np.zeros_like(ids)
    pull = weight * target
    floor = LEAST_GAIN * (pull * target).sum(axis=1)[:, None]
    for level in range(depth + 1):
        k = 1 << level
        slot = ids * k + node
        h = np.bincount(slot.ravel(), weight.ravel(), c * k).reshape(c, k)
        g = np.bincount(slot.ravel(), pull.ravel(), c * k).reshape(c, k)
        trees.cover.append(h)
        trees.value.append(np.divide(g, h + shrink, out=np.zeros_like(g), where=h > 0))
        trees.node.append(node)
        if level == depth:
            return trees
        cell = ((slot[:, :, None] * p + np.arange(p)) * bins + rank).ravel()
        size = c * k * p * bins
        left_h, left_g = (
            np.bincount(cell, np.broadcast_to(v[:, :, None], (c, n, p)).ravel(), size).reshape(c, k, p, bins).cumsum(3)
            for v in (weight, pull)
        )
        all_h, all_g = h[:, :, None, None], g[:, :, None, None]
        right_h = all_h - left_h
        fits = (left_h > 0) & (right_h > 0)
        if allowed is not None:
            fits &= allowed(level)[:, :, :, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_g**2 / (left_h + shrink) + (all_g - left_g) ** 2 / (right_h + shrink) - all_g**2 / (all_h + shrink)
        gain = np.where(fits, gain, -np.inf).reshape(c, k, p * bins)
        top = gain.max(axis=2)
        best = (gain >= (top * (1 - TIE))[:, :, None]).argmax(axis=2)
        feature, low = best // bins, best % bins
        nodes = np.arange(k)[None, :]
        sums = left_h[ids, nodes, feature]
        high = (sums > np.take_along_axis(sums, low[:, :, None], 2)).argmax(axis=2)
        middle = (values[shared, feature, low] + values[shared, feature, high]) / 2
        splits = top > floor
        trees.feature.append(np.where(splits, feature, -1))
        trees.threshold.append(np.where(splits, middle, np.inf))
        trees.gain.append(np.where(splits, top, 0.0))
        at = np.take_along_axis(trees.feature[-1], node, 1)
        right = x[shared, rows, at] > np.take_along_axis(trees.threshold[-1], node, 1)
        node = 2 * node + right


def gains(trees: Trees, p: int, level: int) -> np.ndarray:
    """(C, p): what the splits above a level gain by feature."""
    c = len(trees.cover[0])
    out = np.zeros((c, p))
    for feature, gain in zip(trees.feature[:level], trees.gain[:level], strict=True):
        at = np.arange(c)[:, None] * p + feature
        out += np.bincount(at[feature >= 0], gain[feature >= 0], c * p).reshape(c, p)
    return out


def attributions(x: np.ndarray, trees: Trees, depth: int) -> np.ndarray:
    """(C, p, n): exact path-dependent Shapley values of the trees cut at a depth.

    For a leaf of value v let z_j be the share of the cover that follows the leaf's path at the splits on
    feature j, and o_j whether the row does. Feature j gets v (o_j - z_j) times the integral over t in
    [0, 1] of the product of z_k (1 - t) + o_k t over the other features. That is a polynomial of a degree
    below the number of features on the path, so Gauss-Legendre quadrature is exact; features off the path
    have z = o = 1 and change nothing.
    """
    c, p, n = len(trees.cover[0]), x.shape[2], x.shape[1]
    leaves = np.arange(1 << depth)
    ids = np.arange(c)[:, None]
    shared = ids if len(x) == c else np.zeros_like(ids)
    z, o = np.ones((c, len(leaves), p, 1)), np.ones((c, len(leaves), p, n))
    for level in range(depth):
        above, below = leaves >> (depth - level), leaves >> (depth - level - 1)
        feature, threshold = trees.feature[level][:, above], trees.threshold[level][:, above]
        splits = feature >= 0
        share = np.divide(trees.cover[level + 1][:, below], trees.cover[level][:, above], out=np.ones(splits.shape), where=splits)
        follows = (x.transpose(0, 2, 1)[shared, feature] > threshold[:, :, None]) == (below & 1).astype(bool)[None, :, None]
        on = (np.arange(p) == feature[:, :, None])[..., None]
        z = np.where(on, z * share[:, :, None, None], z)
        o = np.where(on, o * follows[:, :, None, :], o)
    places, parts = np.polynomial.legendre.leggauss(max(1, (min(depth, p) + 1) // 2))
    value = trees.value[depth][:, :, None]
    out = np.zeros((c, p, n))
    for t, part in zip((places + 1) / 2, parts / 2, strict=True):
        factor = z * (1 - t) + o * t
        out += part * ((o - z) / factor * (value * factor.prod(axis=2))[:, :, None, :]).sum(axis=1)
    return out
