"""Shapley contributions of tree leaves for a batch of feature rows; plain numpy, so that it can travel to executors.

A leaf is ``(value, {feature: condition})``, a condition ``(low, high, allowed, share)``: above ``low``, up to ``high``
or, for a category, one of ``allowed``; ``share`` is the share of training rows that follow the path at the feature's
splits.
"""

from __future__ import annotations

import math

import numpy as np

ANYTHING = (-math.inf, math.inf, None, 1.0)
TABULATED = 8  # path features up to which every combination of met conditions is tabulated
LEAVES_AT_ONCE, ROWS_AT_ONCE = 512, 64


def met(condition: tuple, x: np.ndarray) -> np.ndarray:
    """Whether each value satisfies the condition."""
    low, high, allowed, _ = condition
    if allowed is not None:
        return np.isin(x, list(allowed))
    above = ~(x <= low)  # a missing value goes right at every split
    return above if math.isinf(high) else above & (x <= high)


def expected_value(leaf: tuple) -> float:
    value, path = leaf
    return value * math.prod(share for *_, share in path.values())


def subset_weights(size: int) -> np.ndarray:
    """Weight of a subset of the other features, by its size."""
    return np.array([math.factorial(k) * math.factorial(size - 1 - k) / math.factorial(size) for k in range(size)])


def path_contributions(meets: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Contributions per unit of leaf value, for ``meets`` (.., path features) of paths with ``shares``.

    The sum over the subsets of the other features groups by subset size: the sizes' totals are the coefficients of
    ``prod_j (share[j] + meets[j] * t)``.
    """
    size = meets.shape[-1]
    shares = np.broadcast_to(shares, meets.shape)
    weights = subset_weights(size)
    out = np.empty(meets.shape)
    for i in range(size):
        by_size = np.zeros(meets.shape)
        by_size[..., 0] = 1.0
        for j in range(size):
            if j != i:
                grown = by_size * shares[..., [j]]
                grown[..., 1:] += by_size[..., :-1] * meets[..., [j]]
                by_size = grown
        out[..., i] = (meets[..., i] - shares[..., i]) * (by_size @ weights)
    return out


class PathGroup:
    """All leaves whose paths have the same number of features, evaluated together."""

    def __init__(self, leaves: list[tuple], size: int, features: int):
        self.size = size
        self.value = np.array([value for value, _ in leaves])
        self.feature = np.array([list(path) for _, path in leaves])
        conditions = [list(path.values()) for _, path in leaves]
        self.low, self.high, self.share = (
            np.array([[c[at] for c in row] for row in conditions], dtype=float) for at in (0, 1, 3)
        )
        self.open = np.isinf(self.high)
        listed = [(i, j, c[2]) for i, row in enumerate(conditions) for j, c in enumerate(row) if c[2] is not None]
        self.listed = np.array([(i, j) for i, j, _ in listed], dtype=int).reshape(-1, 2)
        most = int(max((max(allowed) for *_, allowed in listed if allowed), default=0))
        self.members = np.zeros((len(listed), most + 1), dtype=bool)
        for at, (*_, allowed) in enumerate(listed):
            self.members[at, [int(a) for a in allowed]] = True
        # which feature each place of each path belongs to, as a matrix that adds places up by feature
        self.spread = np.zeros((self.feature.size, features))
        self.spread[np.arange(self.feature.size), self.feature.ravel()] = 1.0
        self.table = None
        if size <= TABULATED:
            codes = np.arange(1 << size)
            meets = (codes[:, None] >> np.arange(size) & 1).astype(float)
            every = np.broadcast_to(meets, (len(leaves), *meets.shape))
            self.table = path_contributions(every, self.share[:, None, :]) * self.value[:, None, None]

    def meets(self, x: np.ndarray) -> np.ndarray:
        """Whether each row satisfies each condition: (rows, leaves, path features)."""
        values = x[:, self.feature]
        met_ = ~(values <= self.low) & ((values <= self.high) | self.open)  # a missing value goes right
        if len(self.listed):
            i, j = self.listed.T
            own = values[:, i, j]
            known = (own >= 0) & (own < self.members.shape[1])
            code = np.where(known, own, 0).astype(int)
            met_[:, i, j] = known & (code == np.where(known, own, 0)) & self.members[np.arange(len(i)), code]
        return met_

    def add(self, x: np.ndarray, out: np.ndarray) -> None:
        meets = self.meets(x)
        if self.table is None:
            found = path_contributions(meets.astype(float), self.share) * self.value[:, None]
        else:
            code = np.zeros(meets.shape[:2], dtype=np.int64)
            for j in range(self.size):
                code |= meets[..., j].astype(np.int64) << j
            rows = self.table.reshape(-1, self.size)
            found = rows[code + (np.arange(len(self.value)) << self.size)]
        out[:, : self.spread.shape[1]] += found.reshape(len(x), -1) @ self.spread


class LeafTables:
    """Leaves prepared once for any number of batches."""

    def __init__(self, leaves: list[tuple]):
        by_size: dict[int, list[tuple]] = {}
        for leaf in leaves:
            by_size.setdefault(len(leaf[1]), []).append(leaf)
        features = 1 + max((f for _, path in leaves for f in path), default=0)
        # a bounded number of leaves at a time keeps what a batch needs in memory small
        self.groups = [
            PathGroup(group[at : at + LEAVES_AT_ONCE], size, features)
            for size, group in sorted(by_size.items())
            if size
            for at in range(0, len(group), LEAVES_AT_ONCE)
        ]

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Contributions (rows x features) of all leaves."""
        out = np.zeros(x.shape)
        for at in range(0, len(x), ROWS_AT_ONCE):
            for group in self.groups:
                group.add(x[at : at + ROWS_AT_ONCE], out[at : at + ROWS_AT_ONCE])
        return out


def batch_contributions(leaves: list[tuple], x: np.ndarray) -> np.ndarray:
    """Contributions (rows x features) of all leaves, for a single batch."""
    return LeafTables(leaves).contributions(x)
