"""Binned features and trees over them: plain numpy, used on the driver and inside tasks.

Every feature is a small number per row: 0 for a missing number or a category not seen in training, else the place of
the value among the feature's bounds or categories. A split sends a set of a feature's numbers to the left, so numbers,
categories and missing values are treated alike.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np

NUMBER, CATEGORY = "number", "category"


@dataclass(frozen=True)
class Feature:
    """A feature's name and what its bins are: upper bounds of numbers, or categories."""

    name: str
    kind: str
    bounds: tuple[float, ...] = ()
    categories: tuple[str, ...] = ()

    @property
    def bins(self) -> int:
        return 1 + (len(self.bounds) + 1 if self.kind == NUMBER else len(self.categories))

    def binned(self, values) -> np.ndarray:
        if self.kind == CATEGORY:
            number = {c: i + 1 for i, c in enumerate(self.categories)}
            return np.fromiter((number.get(v, 0) for v in values), np.uint16, len(values))
        numbers = np.asarray(values, dtype=float)
        out = 1 + np.searchsorted(np.asarray(self.bounds), numbers, side="left")
        return np.where(np.isnan(numbers), 0, out).astype(np.uint16)


def bin_rows(features: list[Feature], columns) -> np.ndarray:
    """(rows, features) bins of a pandas frame or a mapping of columns."""
    return np.stack([f.binned(columns[f.name]) for f in features], axis=1)


@dataclass
class Tree:
    """Nodes in the order they were made, node 0 the root; ``left`` holds the bins that a split sends to the left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    left: list[list[int]] = field(default_factory=lambda: [[]])
    children: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, left: list[int]) -> tuple[int, int]:
        pair = (len(self.feature), len(self.feature) + 1)
        self.feature[node], self.left[node], self.children[node] = feature, left, pair
        for _ in pair:
            self.feature.append(-1)
            self.left.append([])
            self.children.append((0, 0))
            self.value.append(0.0)
            self.rows.append(0)
        return pair

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf that each row of bins ends in."""
        feature = np.asarray(self.feature)
        width = 1 + max((max(s) for s in self.left if s), default=0)
        goes_left = np.zeros((len(feature), width + 1), bool)  # the last column is for bins beyond
        for node, allowed in enumerate(self.left):
            goes_left[node, allowed] = True
        children = np.asarray(self.children)
        at = np.zeros(len(bins), np.int64)
        moving = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(moving):
            node = at[moving]
            own = np.minimum(bins[moving, feature[node]], width)
            at[moving] = np.where(goes_left[node, own], children[node, 0], children[node, 1])
            moving = moving[feature[at[moving]] >= 0]
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.nodes_of(bins)]


@dataclass
class BoostedTrees:
    """The sum of a bias and of trees, in log-odds."""

    features: list[Feature]
    bias: float
    trees: list[Tree]

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.bias)
        for tree in self.trees:
            out += tree.margins(bins)
        return out

    def leaves(self) -> list[tuple]:
        """(value, {feature number: (low, high, allowed bins, share)}) of all leaves, and the bias as one of its own.

        A condition's share is the share of training rows that follow the path at its feature's splits.
        """
        out = [(self.bias, {})]
        for tree in self.trees:
            pending = [(0, {})]
            while pending:
                node, path = pending.pop()
                feature = tree.feature[node]
                if feature < 0:
                    out.append((tree.value[node], path))
                    continue
                everything = range(self.features[feature].bins)
                allowed, share = path[feature][2:] if feature in path else (tuple(everything), 1.0)
                lefts = set(tree.left[node])
                for child, side in zip(tree.children[node], (lefts, set(everything) - lefts)):
                    kept = tuple(b for b in allowed if b in side)
                    part = tree.rows[child] / tree.rows[node]
                    pending.append((child, {**path, feature: (-np.inf, np.inf, kept, share * part)}))
        return out

    def prediction_change(self) -> np.ndarray:
        """How much each feature moves predictions, adding up to 100: per split the weighted squared distance of both
        sides' mean values from their common mean, weighted by the training rows on either side."""
        out = np.zeros(len(self.features))
        for tree in self.trees:
            mean = list(tree.value)
            for node in reversed(range(len(mean))):
                if tree.feature[node] < 0:
                    continue
                a, b = tree.children[node]
                m, n = tree.rows[a], tree.rows[b]
                mean[node] = (m * mean[a] + n * mean[b]) / max(m + n, 1)
                out[tree.feature[node]] += m * (mean[a] - mean[node]) ** 2 + n * (mean[b] - mean[node]) ** 2
        total = out.sum()
        return 100.0 * out / total if total > 0 else out

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> BoostedTrees:
        told = json.loads(text)
        features = [Feature(f["name"], f["kind"], tuple(f["bounds"]), tuple(f["categories"])) for f in told["features"]]
        trees = [Tree(t["feature"], t["left"], [tuple(c) for c in t["children"]], t["value"], t["rows"]) for t in told["trees"]]
        return BoostedTrees(features, told["bias"], trees)
