"""Tree models as tables: nodes, leaf conditions, and scoring by expression.

A tree model lives on the driver, so its node list is driver-sized by nature;
everything that touches rows stays an expression or a join.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from profilespark.spec import NEGATIVE, POSITIVE


@dataclass(frozen=True)
class Node:
    """One node; ``left`` takes feature <= threshold. Leaves have no feature.

    ``value`` is the probability of the positive class, ``rows`` the training rows seen.
    """

    tree: int
    node: int
    feature: str | None
    threshold: float | None
    left: int | None
    right: int | None
    value: float
    rows: int = 0

    @property
    def is_leaf(self) -> bool:
        return self.feature is None


def _by_tree(nodes: Sequence[Node]) -> dict[int, dict[int, Node]]:
    trees: dict[int, dict[int, Node]] = defaultdict(dict)
    for n in nodes:
        trees[n.tree][n.node] = n
    return trees


def _root(tree: dict[int, Node]) -> Node:
    children = {c for n in tree.values() if not n.is_leaf for c in (n.left, n.right)}
    return next(n for n in tree.values() if n.node not in children)


def score_expression(nodes: Sequence[Node]) -> Column:
    """P(positive class), averaged over the trees, as one expression over the feature columns."""
    def walk(tree: dict[int, Node], n: Node) -> Column:
        if n.is_leaf:
            return F.lit(float(n.value))
        below = walk(tree, tree[n.left]), walk(tree, tree[n.right])
        return F.when(F.col(n.feature) <= F.lit(n.threshold), below[0]).otherwise(below[1])

    trees = _by_tree(nodes)
    votes = [walk(tree, _root(tree)) for _, tree in sorted(trees.items())]
    return sum(votes[1:], votes[0]) / F.lit(float(len(votes)))


def predicted_label(probability: Column) -> Column:
    """Majority label; a tie goes to the positive class, the first in class order."""
    return F.when(probability >= 0.5, F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))


def score_nodes(df: DataFrame, nodes: Sequence[Node]) -> DataFrame:
    """Add ``phishing_probability`` and ``y_pred`` of a small model given as nodes."""
    scored = df.withColumn("phishing_probability", score_expression(nodes))
    return scored.withColumn("y_pred", predicted_label(F.col("phishing_probability")))


def used_features(nodes: Sequence[Node]) -> list[str]:
    return sorted({n.feature for n in nodes if not n.is_leaf})


def thresholds(nodes: Sequence[Node]) -> dict[str, list[float]]:
    """Distinct split points per used feature, ascending."""
    points: dict[str, set[float]] = defaultdict(set)
    for n in nodes:
        if not n.is_leaf:
            points[n.feature].add(float(n.threshold))
    return {f: sorted(p) for f, p in sorted(points.items())}


def leaf_conditions(nodes: Sequence[Node], spark: SparkSession) -> DataFrame:
    """Leaf table in long form: ``tree, leaf, value, feature, bit, low, high``.

    A leaf is reached when every listed feature lies in (low, high]; conditions
    on one feature along a path are merged into one interval. ``value`` already
    carries the tree's share of the average.
    """
    trees = _by_tree(nodes)
    rows, leaf_id = [], 0

    def walk(tree: dict[int, Node], n: Node, box: dict[str, tuple[float, float]]) -> None:
        nonlocal leaf_id
        if n.is_leaf:
            value = float(n.value) / len(trees)
            for bit, (feature, (low, high)) in enumerate(sorted(box.items())):
                rows.append((n.tree, leaf_id, value, feature, bit, low, high))
            if not box:
                rows.append((n.tree, leaf_id, value, None, None, None, None))
            leaf_id += 1
            return
        low, high = box.get(n.feature, (float("-inf"), float("inf")))
        cut = float(n.threshold)
        walk(tree, tree[n.left], {**box, n.feature: (low, min(high, cut))})
        walk(tree, tree[n.right], {**box, n.feature: (max(low, cut), high)})

    for _, tree in sorted(trees.items()):
        walk(tree, _root(tree), {})
    return spark.createDataFrame(
        rows, "tree int, leaf bigint, value double, feature string, bit int, low double, high double"
    )
