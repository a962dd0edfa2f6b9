"""Pairs inside one group of an operator that compares overlapping groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each of ``n`` rows along the links i - j."""
    label = np.arange(n)
    while len(i):
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def first_shared(group: int, groups: pa.ListArray, i: np.ndarray, j: np.ndarray, step: int = 8192) -> np.ndarray:
    """Which pairs of rows have no common group before this one; ``groups`` lists the groups of every row."""
    flat = groups.flatten().to_numpy()
    row = np.repeat(np.arange(len(groups)), groups.value_lengths().to_numpy())
    early = flat < group
    flat, row = flat[early], row[early]
    n = np.bincount(row, minlength=len(groups))
    held = np.full((len(groups), max(1, int(n.max()))), -1, np.int32)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    held[row, at] = np.unique(flat, return_inverse=True)[1].ravel()
    keep = np.ones(len(i), bool)
    for low in range(0, len(i), step):
        a, b = held[i[low : low + step]], held[j[low : low + step]]
        keep[low : low + step] = ~((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any((1, 2))
    return keep
