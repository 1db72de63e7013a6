import json

import pytest

from shelfcast.ml.level_learners import LevelTrees
from shelfcast.ml.models import build_model
from shelfcast.ml.params import DEFAULT_GRIDS, check_grid, grid_points


def test_defaults_are_one_point_each():
    assert {model: len(grid_points(model)) for model in DEFAULT_GRIDS} == {
        "decision": 1, "linear": 1, "randomforest": 1, "gradient": 1
    }


def test_points_vary_the_last_key_fastest():
    points = grid_points("decision", {"model__max_depth": [2, None], "criterion": ["squared_error", "friedman_mse"]})
    assert [(p["criterion"], p["max_depth"]) for p in points] == [
        ("squared_error", 2), ("squared_error", None), ("friedman_mse", 2), ("friedman_mse", None)
    ]


def test_arguments_without_effect_are_no_axes():
    assert grid_points("linear", {"copy_X": [True, False], "n_jobs": [1, 2]}) == [{"fit_intercept": True}]


@pytest.mark.parametrize("model, name, value", [
    ("decision", "max_depth", 0), ("decision", "max_depth", "3"),
    ("decision", "max_depth", True), ("decision", "max_features", "int"), ("decision", "max_features", "float"),
    ("decision", "criterion", "gini"), ("gradient", "criterion", "poisson"), ("gradient", "criterion", "absolute_error"),
    ("decision", "min_impurity_decrease", -0.1), ("decision", "min_samples_split", 1), ("decision", "min_samples_split", 2.0),
    ("decision", "min_samples_leaf", 0), ("randomforest", "min_samples_leaf", 0),
    ("decision", "min_weight_fraction_leaf", 0.5), ("decision", "splitter", "worst"),
    ("randomforest", "n_estimators", 0), ("gradient", "learning_rate", -0.1), ("gradient", "learning_rate", "1"),
    ("gradient", "loss", "deviance"), ("linear", "fit_intercept", 1),
    ("linear", "n_jobs", -1),
])
def test_refused_values_name_the_parameter(model, name, value):
    with pytest.raises(ValueError, match=name):
        check_grid(model, {name: [value]})


def test_refused_grids():
    with pytest.raises(ValueError, match="listed twice"):
        check_grid("decision", {"max_depth": [2, 2]})
    with pytest.raises(ValueError, match="at least one"):
        check_grid("decision", {"max_depth": []})
    with pytest.raises(ValueError, match="n_estimators"):
        check_grid("decision", {"n_estimators": [10]})
    with pytest.raises(ValueError, match="unknown model"):
        check_grid("svm")


def test_mapping_to_spark(spark):
    tree = build_model("decision", grid_points("decision", {"min_samples_leaf": [4], "min_weight_fraction_leaf": [0.1]})[0], 37)
    assert (tree.getMaxDepth(), tree.getNumTrees(), tree.getBootstrap()) == (30, 1, False)
    assert (tree.getMinInstancesPerNode(), tree.getMinWeightFractionPerNode()) == (4, 0.1)
    assert tree.getFeatureSubsetStrategy() == "6"
    forest = build_model("randomforest", grid_points("randomforest", {"max_features": ["log2"]})[0], 37)
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (100, 2, "5")


@pytest.mark.parametrize("model, values", [
    ("decision", {"criterion": "poisson"}), ("decision", {"criterion": "absolute_error"}), ("decision", {"splitter": "random"}),
    ("decision", {"min_samples_split": 3}), ("decision", {"min_impurity_decrease": 0.5}), ("decision", {"max_depth": 31}),
    ("randomforest", {"min_samples_split": 3}), ("randomforest", {"criterion": "poisson"}),
])
def test_values_beyond_spark_are_grown_by_levels(spark, model, values):
    point = grid_points(model, {name: [value] for name, value in values.items()})[0]
    learner = build_model(model, point, 37)
    assert isinstance(learner, LevelTrees)
    rules = json.loads(learner.getOrDefault(learner.rules))
    assert {name: rules[name] for name in values} == values and rules["max_features"] == 6


def test_mapping_of_boosting(spark):
    point = grid_points("gradient", {"loss": ["huber"], "max_features": [None], "learning_rate": [1.5]})[0]
    boosted = build_model("gradient", point, 37, seed=7)
    assert [boosted.getOrDefault(name) for name in ("stages", "rate", "loss", "alpha")] == [100, 1.5, "huber", 0.9]
    rules = json.loads(boosted.getOrDefault(boosted.rules))
    assert (rules["max_depth"], rules["max_features"], rules["seed"]) == (2, None, 7)


def test_learners(spark):
    point = grid_points("randomforest")[0]
    assert build_model("randomforest", point, 37, learner="levels").getOrDefault("trees") == 100
    with pytest.raises(ValueError, match="learner"):
        build_model("randomforest", point, 37, learner="best")
