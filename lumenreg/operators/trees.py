"""Regression trees as plain arrays, and as expressions over raw columns.

``Tree`` is what the histogram engine grows and what MLlib's models are read into.
``TreeEnsemble`` scores rows by one column expression, a nested CASE for each tree: it
stays in generated code, needs no feature vector and can be used from SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenreg.config import FEATURE_COLS, PREDICTION_COL


@dataclass
class Tree:
    """Node i splits feature ``feature[i]`` (-1: a leaf) at ``threshold[i]``: <= goes left."""

    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    level: list = field(default_factory=list)

    def add(self, value: float, level: int) -> int:
        for name, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1),
                        ("value", value), ("gain", 0.0), ("level", level)):
            getattr(self, name).append(v)
        return len(self.value) - 1

    def split(self, node: int, feature: int, threshold: float, gain: float, left: float,
              right: float) -> tuple[int, int]:
        """Make ``node`` an inner node with two new leaves of these values."""
        self.feature[node], self.threshold[node], self.gain[node] = feature, threshold, gain
        self.left[node] = self.add(left, self.level[node] + 1)
        self.right[node] = self.add(right, self.level[node] + 1)
        return self.left[node], self.right[node]

    def cut(self, max_depth: int, min_gain: float = 0.0) -> "Tree":
        """The tree that growth with these limits gives: splits beyond them are left out."""
        out = Tree()

        def copy(node: int) -> int:
            new = out.add(self.value[node], self.level[node])
            if self.feature[node] >= 0 and self.level[node] < max_depth and self.gain[node] >= min_gain:
                out.feature[new], out.threshold[new] = self.feature[node], self.threshold[node]
                out.gain[new] = self.gain[node]
                out.left[new] = copy(self.left[node])
                out.right[new] = copy(self.right[node])
            return new

        copy(0)
        return out

    def arrays(self) -> tuple:
        """Plain arrays for :func:`route` inside tasks."""
        return (np.array(self.feature), np.array(self.threshold, float), np.array(self.left),
                np.array(self.right), np.array(self.value, float))

    def key(self) -> tuple:
        """Equal for trees that predict alike."""
        return (tuple(self.feature), tuple(self.threshold), tuple(self.left), tuple(self.value))

    def column(self, features: list, node: int = 0) -> Column:
        """The prediction as nested CASE expressions over the feature columns."""
        if self.feature[node] < 0:
            return F.lit(float(self.value[node]))
        test = features[self.feature[node]] <= F.lit(float(self.threshold[node]))
        return F.when(test, self.column(features, self.left[node])).otherwise(
            self.column(features, self.right[node]))

    def sql(self, features: list[str], node: int = 0) -> str:
        """The prediction as SQL text."""
        if self.feature[node] < 0:
            return f"CAST('{float(self.value[node])!r}' AS DOUBLE)"
        return (f"CASE WHEN `{features[self.feature[node]]}` <= "
                f"CAST('{float(self.threshold[node])!r}' AS DOUBLE) "
                f"THEN {self.sql(features, self.left[node])} ELSE {self.sql(features, self.right[node])} END")


def route(arrays: tuple, x: np.ndarray) -> np.ndarray:
    """The leaf that each row of ``x`` reaches."""
    feature, threshold, left, right, _ = arrays
    node = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(feature[node] >= 0)
        if not len(inner):
            return node
        at = node[inner]
        goes_left = x[inner, feature[at]] <= threshold[at]
        node[inner] = np.where(goes_left, left[at], right[at])


@dataclass
class TreeEnsemble:
    """A weighted sum of trees over named columns."""

    trees: list
    weights: list
    features: list = field(default_factory=lambda: list(FEATURE_COLS))

    def prediction(self) -> Column:
        columns = [F.col(f"`{c}`").cast("double") for c in self.features]
        terms = [t.column(columns) * F.lit(float(w)) if w != 1 else t.column(columns)
                 for t, w in zip(self.trees, self.weights)]
        return sum(terms[1:], terms[0])

    def sql(self) -> str:
        """An expression over the feature columns, for any SQL statement."""
        return " + ".join(f"({t.sql(self.features)}) * CAST('{float(w)!r}' AS DOUBLE)"
                          for t, w in zip(self.trees, self.weights))

    def transform(self, df: DataFrame, output_col: str = PREDICTION_COL) -> DataFrame:
        return df.withColumn(output_col, self.prediction())

    def smallest_gain(self) -> float:
        """The least gain of any split (infinite without splits)."""
        gains = [g for t in self.trees for f, g in zip(t.feature, t.gain) if f >= 0]
        return min(gains, default=float("inf"))


def _from_node(tree: Tree, node, level: int) -> int:
    new = tree.add(float(node.prediction()), level)
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError("only trees over continuous features can be read")
        tree.feature[new], tree.threshold[new] = split.featureIndex(), float(split.threshold())
        tree.gain[new] = float(node.gain())
        tree.left[new] = _from_node(tree, node.leftChild(), level + 1)
        tree.right[new] = _from_node(tree, node.rightChild(), level + 1)
    return new


def from_mllib(model, features: list[str] = FEATURE_COLS) -> TreeEnsemble:
    """A fitted MLlib tree or boosted model, read node by node, as an expression model.

    ``features`` names the columns in the order in which they were assembled.
    """
    java = model._java_obj
    parts = list(java.trees()) if hasattr(model, "treeWeights") else [java]
    weights = list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0]
    trees = []
    for part in parts:
        tree = Tree()
        _from_node(tree, part.rootNode(), 0)
        trees.append(tree)
    return TreeEnsemble(trees, weights, list(features))
