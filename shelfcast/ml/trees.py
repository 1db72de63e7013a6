"""Regression trees as tables of nodes, and models that add up trees."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F


@dataclass
class Nodes:
    """Nodes of one tree or several; a node is a leaf while its left child is 0, as no root is a child."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)  # values up to it go left
    code: list[int] = field(default_factory=list)  # the same for the codes that the tree was grown on
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)

    def add(self, value: float, depth: int) -> int:
        for column, entry in ((self.feature, 0), (self.cut, 0.0), (self.code, 0), (self.left, 0), (self.right, 0), (self.value, value), (self.depth, depth)):
            column.append(entry)
        return len(self.value) - 1

    @property
    def deepest(self) -> int:
        return max(self.depth, default=0)

    def leaves(self) -> list[int]:
        return [node for node, child in enumerate(self.left) if not child]


@dataclass(frozen=True)
class Flat:
    """Nodes as arrays, from number ``first`` on, for whole batches of rows."""

    feature: np.ndarray
    code: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    first: int

    @staticmethod
    def of(nodes: Nodes, first: int = 0) -> "Flat":
        columns = (nodes.feature, nodes.code, nodes.left, nodes.right, nodes.value)
        return Flat(*[np.array(column[first:]) for column in columns], first)

    def descend(self, codes: np.ndarray, node: np.ndarray, steps: int) -> np.ndarray:
        """Node that each row of codes reaches from ``node`` in at most ``steps``."""
        node = node.copy()
        for _ in range(steps):
            rows = np.flatnonzero(self.left[node - self.first])
            if not len(rows):
                break
            at = node[rows] - self.first
            goes_left = codes[rows, self.feature[at]] <= self.code[at]
            node[rows] = np.where(goes_left, self.left[at], self.right[at])
        return node

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        return self.descend(codes, np.zeros(len(codes), np.int64), len(self.left))


def constant(values: list, kind: str) -> str:
    """SQL for an array of numbers as one constant; from a text, as thousands of literals are slow to plan."""
    return f"cast(split('{','.join(map(repr, values))}', ',') AS array<{kind}>)"


def descend(nodes: Nodes, x: str, start: Column, steps: int, first: int = 0) -> Column:
    """Node that a row reaches from ``start`` in at most ``steps``.

    ``x`` is the array of feature values, or ``codes``. Only nodes from number ``first`` on are looked at.
    """
    if not steps:
        return start
    feature, left, right = (F.expr(constant(column[first:], "int")) for column in (nodes.feature, nodes.left, nodes.right))
    cut = F.expr(constant(nodes.code[first:], "int") if x == "codes" else constant(nodes.cut[first:], "double"))

    def step(node: Column, _: Column) -> Column:
        at = node - first
        down = F.when(F.get(F.col(x), F.get(feature, at)) <= F.get(cut, at), F.get(left, at)).otherwise(F.get(right, at))
        return F.when(F.get(left, at) == 0, node).otherwise(down)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start.cast("int"), step)


def tree_values(nodes: Nodes, x: str, roots: int = 1) -> Column:
    """Sum of the values that a row reaches in the trees with the first ``roots`` nodes as roots."""
    values = F.expr(constant(nodes.value, "double"))
    if roots == 1:
        return F.get(values, descend(nodes, x, F.lit(0), nodes.deepest))
    ends = F.transform(F.sequence(F.lit(0), F.lit(roots - 1)), lambda root: F.get(values, descend(nodes, x, root, nodes.deepest)))
    return F.aggregate(ends, F.lit(0.0), lambda total, value: total + value)


class TreesModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Prediction ``start + rate * (sum over groups of trees)``.

    A group is ``roots`` trees in one table of nodes, as a forest is; boosting has a group per stage.
    """

    groups = Param(Params._dummy(), "groups", "JSON list of node tables", TypeConverters.toString)
    roots = Param(Params._dummy(), "roots", "trees per group", TypeConverters.toInt)
    start = Param(Params._dummy(), "start", "prediction before any tree", TypeConverters.toFloat)
    rate = Param(Params._dummy(), "rate", "weight of every tree", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, **kwargs) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", roots=1, start=0.0, rate=1.0)
        self._set(**self._input_kwargs)

    @staticmethod
    def of(groups: list[Nodes], **settings) -> "TreesModel":
        return TreesModel(groups=json.dumps([asdict(nodes) for nodes in groups]), **settings)

    @property
    def node_tables(self) -> list[Nodes]:
        return [Nodes(**table) for table in json.loads(self.getOrDefault(self.groups))]

    @property
    def depth(self) -> int:
        return max(nodes.deepest for nodes in self.node_tables)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = "__features"
        total = F.lit(0.0)
        for nodes in self.node_tables:
            total = total + tree_values(nodes, x, self.getOrDefault(self.roots))
        prediction = F.lit(self.getOrDefault(self.start)) + self.getOrDefault(self.rate) * total
        found = dataset.withColumn(x, vector_to_array(self.getFeaturesCol()))
        return found.withColumn(self.getPredictionCol(), prediction).drop(x)
