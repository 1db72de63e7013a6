"""Spark ML estimators over trees grown by levels: single trees, forests and boosting."""

from __future__ import annotations

import json
from contextlib import ExitStack
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.ml.growing import Codes, Grower, Rules, draw_column, lists, matrix, poisson_count
from shelfcast.ml.trees import Flat, Nodes, TreesModel, constant
from shelfcast.operators.copies import merge_copies, repeat_copies
from shelfcast.operators.quantiles import group_quantiles
from shelfcast.session import materialized

STORE_EVERY = 10  # stages of boosting
DIGITS = 6  # of a row's values that tell rows apart when a forest draws them


class _Learner(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    rules = Param(Params._dummy(), "rules", "JSON of the rules of growing", TypeConverters.toString)

    @keyword_only
    def __init__(self, **kwargs) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _rules(self) -> Rules:
        return Rules(**json.loads(self.getOrDefault(self.rules)))

    def _rows(self, dataset: DataFrame) -> DataFrame:
        label = F.col(self.getLabelCol()).cast("double").alias("y")
        return dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), label).filter("y IS NOT NULL")

    def _model(self, groups: list[Nodes], **settings) -> TreesModel:
        columns = {"featuresCol": self.getFeaturesCol(), "predictionCol": self.getPredictionCol()}
        return TreesModel.of(groups, **columns, **settings)


def rules_text(**rules) -> str:
    return json.dumps(asdict(Rules(**rules)))


class LevelTrees(_Learner):
    """One tree, or a forest whose prediction is the mean of its trees.

    With ``bootstrap`` each tree counts every row as often as Poisson(1) says for a digest of (seed,
    tree, the row's values, number of the copy among equal rows): a seed repeats a forest whatever the
    order and partitioning of rows. Values that agree to six decimals count as equal for this.
    """

    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    bootstrap = Param(Params._dummy(), "bootstrap", "whether each tree draws its rows", TypeConverters.toBoolean)

    def _fit(self, dataset: DataFrame) -> TreesModel:
        rules, trees, bootstrap = self._rules(), self.getOrDefault(self.trees), self.getOrDefault(self.bootstrap)
        rows = self._rows(dataset)
        with ExitStack() as stack:
            if bootstrap:
                rows = repeat_copies(merge_copies(rows)).select("x", "y", _content().alias("content"))
            rows = stack.enter_context(materialized(rows, "tree-rows"))
            width = _width(rows)
            if rules.criterion == "poisson":
                _check_counts(rows)
            codes = Codes.of(rows, width, rules.most_values)
            grown = stack.enter_context(materialized(codes.encode(rows), "coded-rows"))
            grown = grown.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
            if bootstrap:
                drawn = poisson_count(draw_column(rules.seed, F.col("node").cast("string"), F.col("content")))
                grown = grown.withColumn("w", drawn.cast("double")).filter("w > 0")
            else:
                grown = grown.withColumn("w", F.lit(1.0))
            nodes = Grower(rules, codes, trees).grow(grown.select("codes", "y", "w", "node"))
        return self._model([nodes], roots=trees, rate=1.0 / trees)


def _width(rows: DataFrame) -> int:
    """Number of features."""
    first = rows.select(F.size("x").alias("width")).first()
    if first is None:
        raise ValueError("a model needs at least one row with a label")
    return first["width"]


def _content() -> Column:
    def text(value: Column) -> Column:
        return F.round(value * 10**DIGITS).cast("decimal(38,0)").cast("string")

    return F.md5(F.concat_ws("/", F.transform("x", text), text(F.col("y")), F.col("copy").cast("string")))


def _check_counts(rows: DataFrame) -> None:
    low, total = rows.agg(F.min("y"), F.sum("y")).first()
    if low is not None and (low < 0 or total <= 0):
        raise ValueError("criterion='poisson' needs labels of at least 0 that are not all 0")


class Boosting(_Learner):
    """Boosting from the best constant, every tree shrunk by the learning rate.

    Each stage grows a tree on the negative gradient of the loss at the running prediction, which is
    stored with the rows every ``STORE_EVERY`` stages, so that the work is linear in the stages. Equal rows
    are merged at the start and weighted by their number ``w``, as every stage goes through all of them. Leaves
    of a loss other than squared error are then set to the residual that is best for the loss: their
    median or quantile, exactly, from counts per distinct residual sorted over all tasks.
    """

    stages = Param(Params._dummy(), "stages", "number of trees", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "learning rate", TypeConverters.toFloat)
    loss = Param(Params._dummy(), "loss", "squared_error, absolute_error, huber or quantile", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "share of huber's clip and of quantile", TypeConverters.toFloat)

    def _fit(self, dataset: DataFrame) -> TreesModel:
        rules, rate, loss, alpha = self._rules(), *map(self.getOrDefault, (self.rate, self.loss, self.alpha))
        groups: list[Nodes] = []
        with ExitStack() as stack:
            merged = merge_copies(self._rows(dataset)).select("x", "y", F.col("copies").cast("double").alias("w"))
            rows = stack.enter_context(materialized(merged, "boosted-rows"))
            width = _width(rows)
            codes = Codes.of(rows, width, rules.most_values)
            if loss == "squared_error":
                start = rows.agg(_mean(F.col("y"))).first()[0]
            else:
                start = _quantile(rows.select("y", "w"), "y", alpha if loss == "quantile" else 0.5)
            held = stack.enter_context(ExitStack())
            coded = codes.encode(rows).withColumn("f", F.lit(float(start)))
            table = held.enter_context(materialized(coded, "boosted-rows"))
            since: list[Flat] = []
            for stage in range(self.getOrDefault(self.stages)):
                state = Residuals(width, tuple(since), rate, loss, alpha)
                if len(since) == STORE_EVERY:
                    following = ExitStack()
                    table = following.enter_context(materialized(_moved(table, state), "boosted-rows"))
                    held.close()
                    held, since = stack.enter_context(following), []
                    state = replace(state, trees=())
                if loss == "huber":
                    away = _residuals(table, state).select(F.abs("r").alias("r"), "w")
                    state = replace(state, clip=_quantile(away, "r", alpha))
                nodes = Grower(replace(rules, seed=f"{rules.seed}/{stage}"), codes).grow(table, state)
                if loss != "squared_error":
                    _refit(nodes, table, state)
                groups.append(nodes)
                since.append(Flat.of(nodes))
        return self._model(groups, start=float(start), rate=rate)


@dataclass(frozen=True)
class Residuals:
    """State of rows with columns ``codes, y, w, f``, whose prediction is ``f`` moved by some trees."""

    width: int
    trees: tuple[Flat, ...]
    rate: float
    loss: str
    alpha: float
    clip: float = 0.0

    def prediction(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Codes and predictions."""
        codes, moved = matrix(batch.column("codes"), self.width), np.array(batch.column("f").to_numpy(zero_copy_only=False))
        for tree in self.trees:
            moved += self.rate * tree.value[tree.leaf_of(codes)]
        return codes, moved

    def residual(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        codes, moved = self.prediction(batch)
        return codes, batch.column("y").to_numpy(zero_copy_only=False) - moved

    def __call__(self, batch: pa.RecordBatch):
        """What a tree is grown on: the negative gradient of the loss."""
        codes, r = self.residual(batch)
        if self.loss == "absolute_error":
            r = np.where(r < 0, -1.0, 1.0)
        elif self.loss == "quantile":
            r = np.where(r < 0, self.alpha - 1.0, self.alpha)
        elif self.loss == "huber":
            r = np.clip(r, -self.clip, self.clip)
        return codes, r, batch.column("w").to_numpy(zero_copy_only=False), np.zeros(len(r), np.int64)


def _moved(table: DataFrame, state: Residuals) -> DataFrame:
    """``table`` with its predictions moved by the state's trees."""

    def move(batches):
        for batch in batches:
            codes, moved = state.prediction(batch)
            yield pa.RecordBatch.from_arrays([lists(codes), batch.column("y"), batch.column("w"), pa.array(moved)], ["codes", "y", "w", "f"])

    return table.select("codes", "y", "w", "f").mapInArrow(move, "codes array<int>, y double, w double, f double")


def _residuals(table: DataFrame, state: Residuals, tree: Flat | None = None) -> DataFrame:
    """``leaf, r, w``: residuals, and the leaves of ``tree``."""

    def find(batches):
        for batch in batches:
            codes, r = state.residual(batch)
            leaf = tree.leaf_of(codes) if tree else np.zeros(len(r))
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), pa.array(r), batch.column("w")], ["leaf", "r", "w"])

    return table.mapInArrow(find, "leaf int, r double, w double")


def _mean(value: Column) -> Column:
    return F.sum(value * F.col("w")) / F.sum("w")


def _quantile(df: DataFrame, value: str, share: float) -> float:
    return group_quantiles(df.withColumn("all", F.lit(0)), ["all"], value, share, "w")[0]["quantile"]


def _refit(nodes: Nodes, table: DataFrame, state: Residuals) -> None:
    """Sets the leaves to the best residual for the loss."""
    rows = _residuals(table, state, Flat.of(nodes))
    for row in group_quantiles(rows, ["leaf"], "r", state.alpha if state.loss == "quantile" else 0.5, "w"):
        nodes.value[row["leaf"]] = float(row["quantile"])
    if state.loss == "huber":
        away = F.col("r") - F.get(F.expr(constant(nodes.value, "double")), F.col("leaf"))
        step = F.signum(away) * F.least(F.abs(away), F.lit(state.clip))
        for row in rows.groupBy("leaf").agg(_mean(step).alias("step")).collect():
            nodes.value[row["leaf"]] += float(row["step"])
