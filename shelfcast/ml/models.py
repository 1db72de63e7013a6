"""The four regressors as estimators, and fitting one behind the preprocessor."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.columns import clip_at_zero
from shelfcast.ml.level_learners import Boosting, LevelTrees, rules_text
from shelfcast.ml.params import DEEPEST, grid_points
from shelfcast.ml.preprocess import preprocessor
from shelfcast.operators.filters import NUMERIC, feature_frame
from shelfcast.session import materialized

COLUMNS = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}

LEAST_BINS = 32
ALPHA = 0.9  # fixed value: share of the huber and quantile losses


def distinct_values(rows: DataFrame) -> int:
    """Largest number of distinct values of a numeric feature, with one more for a fill value.

    As many bins let a tree consider every split between neighbouring values. Beyond 10,000 rows and
    the square of the bins, Spark ML looks for split candidates in a sample of that size.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in NUMERIC]))
    values = rows.select(pairs.alias("pair")).select("pair.*").filter("value IS NOT NULL").distinct()
    return max(LEAST_BINS, *(row["count"] + 1 for row in values.groupBy("name").count().collect()))


def _tried(rule: str | None, width: int) -> int | None:
    """Features tried per split: the roots and logarithms are rounded down. None is all."""
    if rule is None:
        return None
    return max(1, int(math.sqrt(width) if rule == "sqrt" else math.log2(width)))


def _tree_settings(params: Mapping, width: int, max_bins: int) -> dict:
    return {
        **COLUMNS,
        "maxDepth": params["max_depth"] or DEEPEST,
        "maxBins": max_bins,
        "featureSubsetStrategy": str(_tried(params["max_features"], width) or "all"),
        "checkpointInterval": 10,
    }


def _rules(params: Mapping, width: int, seed: int, max_bins: int) -> str:
    """The rules of trees grown by levels."""
    names = ("criterion", "splitter", "max_depth", "min_samples_split", "min_samples_leaf", "min_weight_fraction_leaf",
             "min_impurity_decrease")
    given = {name: params[name] for name in names if name in params}
    return rules_text(**given, max_features=_tried(params["max_features"], width), max_bins=max_bins, seed=seed)


def spark_grows(params: Mapping) -> bool:
    """Whether Spark ML's tree learner honours all values."""
    return (
        params["criterion"] in ("friedman_mse", "squared_error") and params.get("splitter", "best") == "best"
        and params["min_samples_split"] == 2 and not params["min_impurity_decrease"] and (params["max_depth"] or 0) <= DEEPEST
    )


def linear(params: Mapping, width: int, seed: int, max_bins: int) -> Pipeline:
    """Least squares. One aggregation pass; the small normal equations are solved on the driver.

    All family slots together equal the intercept column. With an intercept the last slot is left
    out, which changes no prediction and lets the equations be solved exactly. Where a column is
    still redundant (no holiday in the year) the solver iterates on them, hence the tolerance.
    """
    intercept = params["fit_intercept"]
    used = VectorSlicer(inputCol="features", outputCol="used", indices=list(range(width - intercept)))
    solver = LinearRegression(
        featuresCol="used", labelCol="label", solver="auto", regParam=0.0,
        fitIntercept=intercept, maxIter=10000, tol=1e-14,
    )
    return Pipeline(stages=[used, solver])


def decision_tree(params: Mapping, width: int, seed: int, max_bins: int):
    """One tree on all rows.

    Where Spark ML honours the values this is its forest of one tree, which unlike its plain tree can
    try a subset of features; else the tree is grown by levels.
    """
    if not spark_grows(params):
        return deep_tree(params, width, seed, max_bins)
    return RandomForestRegressor(
        **_tree_settings(params, width, max_bins),
        numTrees=1,
        bootstrap=False,
        cacheNodeIds=True,
        minInstancesPerNode=params["min_samples_leaf"],
        minWeightFractionPerNode=float(params["min_weight_fraction_leaf"]),
        seed=seed,
    )


def deep_tree(params: Mapping, width: int, seed: int, max_bins: int) -> LevelTrees:
    """One tree grown by levels, of any depth."""
    return LevelTrees(rules=_rules(params, width, seed, max_bins), trees=1, bootstrap=False)


def random_forest(params: Mapping, width: int, seed: int, max_bins: int):
    if not spark_grows(params) or params["max_depth"] is None:
        return repeatable_forest(params, width, seed, max_bins)
    return RandomForestRegressor(
        **_tree_settings(params, width, max_bins),
        numTrees=params["n_estimators"],
        minInstancesPerNode=params["min_samples_leaf"],
        seed=seed,
    )


def repeatable_forest(params: Mapping, width: int, seed: int, max_bins: int) -> LevelTrees:
    """A forest grown by levels: a seed repeats it on any partitioning of the rows."""
    return LevelTrees(rules=_rules(params, width, seed, max_bins), trees=params["n_estimators"], bootstrap=True)


def gradient_boosting(params: Mapping, width: int, seed: int, max_bins: int) -> Boosting:
    """Boosting from the mean (or the loss's best constant), every tree shrunk by the learning rate."""
    return Boosting(
        rules=_rules(params, width, seed, max_bins), stages=params["n_estimators"], rate=float(params["learning_rate"]),
        loss=params["loss"], alpha=ALPHA,
    )


BUILDERS = {
    "decision": decision_tree,
    "linear": linear,
    "randomforest": random_forest,
    "gradient": gradient_boosting,
}


# The same models grown by levels whatever the values, so that a seed repeats them on any partitioning.
BY_LEVELS = {"decision": deep_tree, "randomforest": repeatable_forest, "gradient": gradient_boosting}
LEARNERS = ("auto", "levels")


def build_model(
    model: str, params: Mapping, width: int, seed: int = 42, max_bins: int = LEAST_BINS, learner: str = "auto"
):
    """Unfitted estimator for one grid point and a feature vector of ``width`` slots."""
    if learner not in LEARNERS:
        raise ValueError(f"learner {learner!r}: choose one of {LEARNERS}")
    if learner == "levels" and model in BY_LEVELS:
        return BY_LEVELS[model](params, width, seed, max_bins)
    return BUILDERS[model](params, width, seed, max_bins)


def _cut_off(fitted, params: Mapping) -> bool:
    """Whether a tree without a depth limit grew as deep as Spark ML allows."""
    return params.get("max_depth", DEEPEST) is None and isinstance(fitted, RandomForestRegressionModel) and any(
        tree.depth >= DEEPEST for tree in fitted.trees
    )


def vector_width(vectors: DataFrame) -> int:
    return vectors.schema["features"].metadata["ml_attr"]["num_attrs"]


def with_label(df: DataFrame) -> DataFrame:
    """Training label: sales, negative ones as 0."""
    return df.withColumn("label", clip_at_zero())


def fit_prepared(
    rows: DataFrame, prepared: PipelineModel, model: str, params: Mapping, seed: int, max_bins: int, learner: str = "auto"
) -> PipelineModel:
    """One model fitted on stored feature rows behind a fitted preprocessor; returns both.

    A tree without a depth limit that Spark ML cut off at its deepest level is grown again by levels.

    Vectors are assembled anew in each pass instead of being cached: the stored columns are several
    times smaller, and the tree learners keep their own binned copy.
    """
    vectors = prepared.transform(rows).select("features", "label")
    fitted = build_model(model, params, vector_width(vectors), seed, max_bins, learner).fit(vectors)
    if _cut_off(fitted, params):
        fitted = build_model(model, params, vector_width(vectors), seed, max_bins, "levels").fit(vectors)
    return PipelineModel(stages=[prepared, fitted])


def fit_model(
    df: DataFrame,
    model: str,
    params: Mapping | None = None,
    num_strategy: str = "mean",
    cat_strategy: str = "most_frequent",
    seed: int = 42,
    max_bins: int | None = None,
    learner: str = "auto",
) -> PipelineModel:
    """Preprocessor and one model fitted on feature rows with a ``label``.

    The needed columns are written to the shared folder for the time of the fit, which reads them
    many times. Without ``params`` the model's default grid point is used. ``max_bins`` bounds the
    split candidates of a tree; without it there is one per distinct value. ``learner="levels"`` grows
    trees and forests by levels even where Spark ML could: slower, but a seed repeats them on any
    partitioning.
    """
    params = params or grid_points(model)[0]
    with materialized(feature_frame(df, "label"), "training") as rows:
        prepared = preprocessor(num_strategy, cat_strategy).fit(rows)
        return fit_prepared(rows, prepared, model, params, seed, bins_for(model, rows, max_bins), learner)


def bins_for(model: str, rows: DataFrame, max_bins: int | None) -> int:
    return max_bins or (LEAST_BINS if model == "linear" else distinct_values(rows))


def predict(fitted: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with a ``prediction`` column."""
    return fitted.transform(df).select(*df.columns, "prediction")
