"""Decision trees as arrays: what they predict for many rows at once, and exact Shapley values of their predictions.

A row goes left where its value is below the node's limit; a missing value goes where the node says. Shapley values use
path-dependent expectations: a feature left out follows both branches, weighted by their covers. One walk over a tree's nodes
carries, for all rows of a block, the weights of feature subsets by size (extended by a feature when a node splits on it, unwound
when a path meets it again), so time is nodes x depth x rows and memory is a path, whatever the number of leaves.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

# executors get the functions below by value and need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that are walked through a tree together, so that the weights of a path stay in the processor's cache.
BLOCK = 2_048


@dataclass
class Tree:
    """Nodes by number, the root first; `left` is -1 for a leaf. Leaves have values, all nodes have covers."""

    feature: np.ndarray
    limit: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @classmethod
    def of(cls, rows: Sequence[tuple]) -> Tree:
        """From rows (feature, limit, missing_left, left, right, value, cover)."""
        kinds = (np.int32, float, bool, np.int32, np.int32, float, float)
        return cls(*(np.array(c, k) for c, k in zip(zip(*rows), kinds)))

    def goes_left(self, node, values):
        """Whether values of the node's feature go left; for one node or one for each value."""
        return np.where(np.isnan(values), self.missing_left[node], values < self.limit[node])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at, row = np.zeros(len(x), np.int32), np.arange(len(x))
        while True:
            inner = self.left[at] >= 0
            if not inner.any():
                return at
            own = at[inner]
            left = self.goes_left(own, x[row[inner], self.feature[own]])
            at[inner] = np.where(left, self.left[own], self.right[own])

    def expected(self) -> float:
        """The prediction when no feature is known: leaves weighted by their share of the cover at each branch."""
        share = np.zeros(len(self.left))
        share[0] = 1.0
        for node in range(len(self.left)):  # children come after their parents
            for child in (self.left[node], self.right[node]) if self.left[node] >= 0 else ():
                share[child] = share[node] * self.cover[child] / self.cover[node]
        return float((share * self.value)[self.left < 0].sum())


def outputs(x: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """The sum of the trees' predictions for each row."""
    total = np.zeros(len(x))
    for tree in trees:
        total += tree.value[tree.leaves(x)]
    return total


def _extended(w: np.ndarray, zero: float, one: np.ndarray) -> np.ndarray:
    """Subset weights (by size, by row) after a feature whose branch has the share `zero` and which rows `one` follow."""
    size = len(w)
    step = np.arange(1, size + 1)[:, None] / (size + 1)
    out = np.empty((size + 1, w.shape[1]))
    out[:-1] = w * (zero * step[::-1])
    out[-1] = 0.0
    out[1:] += w * (step * one)
    return out


def _unwound(w: np.ndarray, zero: float, one: np.ndarray) -> np.ndarray:
    """The weights before a feature was added (in any order): `_extended` undone."""
    size = len(w) - 1
    followed, left_out, rest = np.empty((size, w.shape[1])), np.empty((size, w.shape[1])), w[-1]
    for i in range(size - 1, -1, -1):
        followed[i] = rest * (size + 1) / (i + 1)
        rest = w[i] - followed[i] * zero * (size - i) / (size + 1)
        left_out[i] = w[i] * (size + 1) / (zero * (size - i))
    return np.where(one, followed, left_out)


def _sums(zeros: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of factors for each feature of a path: applied to its weights they give the summed weights without that feature.

    The first for rows that follow the feature's branch, the second (to be divided by its share) for the others.
    """
    rest, followed = np.zeros((len(zeros), size + 1)), np.zeros((len(zeros), size + 1))
    rest[:, size] = 1.0
    for i in range(size - 1, -1, -1):
        part = rest * ((size + 1) / (i + 1))
        followed += part
        rest = -part * (zeros * ((size - i) / (size + 1)))[:, None]
        rest[:, i] += 1.0
    left_out = np.append((size + 1) / (size - np.arange(size)), 0.0)
    return followed, left_out


def _walk(tree: Tree, x: np.ndarray, phi: np.ndarray) -> None:
    """Adds a tree's Shapley values for the rows of `x` to `phi` (feature by row)."""
    start: tuple = (0, (), np.ones((1, len(x))))  # node, path of (feature, share, followed), weights by subset size
    stack = [start]
    while stack:
        node, path, w = stack.pop()
        if tree.left[node] < 0:
            if path and tree.value[node]:
                features = [f for f, _, _ in path]
                zeros, ones = np.array([z for _, z, _ in path]), np.stack([o for _, _, o in path])
                followed, left_out = _sums(zeros, len(path))
                phi[features] += tree.value[node] * np.where(ones, (followed @ w) * (1 - zeros)[:, None], -(left_out @ w))
            continue
        feature = int(tree.feature[node])
        goes, met = tree.goes_left(node, x[:, feature]), next((p for p in path if p[0] == feature), None)
        zero, one = 1.0, np.ones(len(x), bool)
        if met:
            _, zero, one = met
            path, w = tuple(p for p in path if p[0] != feature), _unwound(w, zero, one)
        for child, follows in ((tree.left[node], goes), (tree.right[node], ~goes)):
            share = zero * tree.cover[child] / tree.cover[node]
            if share > 0:  # nothing is known to have gone down a branch without cover
                follows = one & follows
                stack.append((child, (*path, (feature, share, follows)), _extended(w, share, follows)))


def shapley_values(x: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """Exact path-dependent Shapley values (row by feature); with the trees' expected values they add up to the outputs."""
    phi = np.zeros((len(x), x.shape[1]))
    for at in range(0, len(x), BLOCK):
        part = np.zeros((x.shape[1], len(x[at:at + BLOCK])))
        for tree in trees:
            _walk(tree, x[at:at + BLOCK], part)
        phi[at:at + BLOCK] = part.T
    return phi
