"""Isolation trees over a small numpy sample (used inside tasks).

Trees are complete binary heaps: the children of cell ``i`` are ``2i + 1`` and
``2i + 2``, so all trees grow and are searched level by level at once.
"""

from __future__ import annotations

import numpy as np

EULER = 0.5772156649015329


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype="float64")
    full = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, full, np.where(n == 2, 1.0, 0.0))


def grow_forest(data: np.ndarray, trees: int, tree_rows: int, seed: int) -> dict:
    """Trees over ``tree_rows`` rows each, drawn from ``data``."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(data))
    drawn = np.concatenate([rng.choice(len(data), size, replace=False) for _ in range(trees)])
    return grow_trees(data[drawn], np.repeat(np.arange(trees), size), trees, seed)


def grow_trees(points: np.ndarray, tree: np.ndarray, trees: int, seed: int) -> dict:
    """Flat heaps of ``trees`` trees over their drawn points: feature (-1 marks a leaf), cut, path length."""
    rng = np.random.default_rng(seed)
    size = int(np.bincount(tree).max())
    levels = int(np.ceil(np.log2(max(size, 2))))
    cells = 2 ** (levels + 1) - 1
    feature = np.full(trees * cells, -1, dtype="int32")
    cut, depth = np.zeros(trees * cells), np.zeros(trees * cells)
    at = tree * cells
    for level in range(levels + 1):
        order = np.argsort(at, kind="stable")
        points, at = points[order], at[order]
        here, first, count = np.unique(at, return_index=True, return_counts=True)
        low = np.minimum.reduceat(points, first, axis=0)
        high = np.maximum.reduceat(points, first, axis=0)
        draw = np.where(high > low, rng.random(low.shape), -1.0)
        chosen = draw.argmax(axis=1)
        group = np.arange(len(here))
        splits = (count > 1) & (level < levels) & (draw[group, chosen] >= 0)
        depth[here] = np.where(splits, 0.0, level + mean_path(count))
        lo, hi = low[group, chosen].astype("float64"), high[group, chosen].astype("float64")
        value = lo + rng.random(len(here)) * (hi - lo)
        feature[here] = np.where(splits, chosen, -1)
        cut[here] = value
        member = np.repeat(group, count)
        alive = splits[member]
        points, at, member = points[alive], at[alive], member[alive]
        if len(at) == 0:
            break
        right = points[np.arange(len(at)), chosen[member]] > value[member]
        heap = at // cells * cells
        at = heap + 2 * (at - heap) + 1 + right
    return {
        "feature": feature.tolist(),
        "cut": cut.tolist(),
        "depth": depth.tolist(),
        "cells": cells,
        "scale": float(mean_path(size)),
    }


def score_rows(data: np.ndarray, model) -> np.ndarray:
    """Negative anomaly score of each row: near -1 is an outlier, near 0 is not."""
    cells = int(model["cells"])
    feature = np.asarray(model["feature"]).reshape(-1, cells)
    cut = np.asarray(model["cut"]).reshape(-1, cells)
    depth = np.asarray(model["depth"]).reshape(-1, cells)
    wide = data.astype("float64")
    rows = np.arange(len(data))
    total = np.zeros(len(data))
    for f, c, d in zip(feature, cut, depth):
        at = np.zeros(len(data), dtype="int64")
        inner = f[at] >= 0
        while inner.any():
            go = wide[rows, np.maximum(f[at], 0)] > c[at]
            at = np.where(inner, 2 * at + 1 + go, at)
            inner = f[at] >= 0
        total += d[at]
    return -np.power(2.0, -total / len(feature) / (model["scale"] or 1.0))
