"""Model grids: defaults, allowed values, and how each parameter reaches Spark ML.

A grid maps parameter names to lists of values. Everything is checked before a Spark job starts. A
value that cannot be honoured is refused by name rather than replaced by something else.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import product

# Default grid of each model.
DEFAULT_GRIDS: dict[str, dict[str, list]] = {
    "decision": {
        "max_depth": [None],
        "max_features": ["sqrt"],
        "criterion": ["friedman_mse"],
        "min_impurity_decrease": [0.0],
        "min_samples_split": [2],
        "min_samples_leaf": [1],
        "min_weight_fraction_leaf": [0.0],
        "splitter": ["best"],
    },
    "linear": {"fit_intercept": [True], "copy_X": [True], "n_jobs": [5]},
    "randomforest": {
        "n_estimators": [100],
        "max_depth": [2],
        "max_features": ["sqrt"],
        "criterion": ["friedman_mse"],
        "min_impurity_decrease": [0.0],
        "min_samples_split": [2],
        "min_samples_leaf": [1],
    },
    "gradient": {
        "n_estimators": [100],
        "max_depth": [2],
        "max_features": ["sqrt"],
        "learning_rate": [0.1],
        "loss": ["squared_error"],
        "criterion": ["friedman_mse"],
        "min_impurity_decrease": [0.0],
        "min_samples_split": [2],
    },
}

MODELS = list(DEFAULT_GRIDS)
DEEPEST = 30  # Spark ML's limit on tree depth; deeper trees are grown by levels

# Accepted so that grids can be carried over, but not axes of the search: frames are immutable, and
# parallelism is an argument of the search.
NO_EFFECT = {"copy_X", "n_jobs"}


def _is_int(value, low: int, high: int | None = None) -> bool:
    return isinstance(value, int) and not isinstance(value, bool) and value >= low and (high is None or value <= high)


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


# Criteria of splits, those that boosting offers, and losses.
CRITERIA = ("friedman_mse", "squared_error", "absolute_error", "poisson")
BOOSTING_CRITERIA = ("friedman_mse", "squared_error")
LOSSES = ("squared_error", "absolute_error", "huber", "quantile")

CHECKS: dict[str, tuple[Callable[[object], bool], str]] = {
    "max_depth": (lambda v: v is None or _is_int(v, 1), "None or at least 1"),
    "max_features": (lambda v: v in ("sqrt", "log2", None), "'sqrt', 'log2' or None"),
    "criterion": (lambda v: v in CRITERIA, f"one of {CRITERIA}"),
    "min_impurity_decrease": (lambda v: _is_number(v) and v >= 0, "at least 0"),
    "min_samples_split": (lambda v: _is_int(v, 2), "at least 2"),
    "min_samples_leaf": (lambda v: _is_int(v, 1), "at least 1"),
    "min_weight_fraction_leaf": (lambda v: _is_number(v) and 0 <= v < 0.5, "from 0 to below 0.5"),
    "splitter": (lambda v: v in ("best", "random"), "'best' or 'random'"),
    "n_estimators": (lambda v: _is_int(v, 1), "at least 1"),
    "learning_rate": (lambda v: _is_number(v) and v >= 0, "at least 0"),
    "loss": (lambda v: v in LOSSES, f"one of {LOSSES}"),
    "fit_intercept": (lambda v: isinstance(v, bool), "True or False"),
    "copy_X": (lambda v: isinstance(v, bool), "True or False"),
    "n_jobs": (lambda v: _is_int(v, 0), "at least 0"),
}


MODEL_CHECKS = {
    ("gradient", "criterion"): (lambda v: v in BOOSTING_CRITERIA, f"one of {BOOSTING_CRITERIA}"),
}


def check_grid(model: str, grid: Mapping[str, Sequence] | None = None) -> dict[str, list]:
    """The full grid of ``model``: its defaults, overridden by ``grid``. Raises on anything unusable.

    Names may carry the pipeline prefix ``model__``.
    """
    if model not in DEFAULT_GRIDS:
        raise ValueError(f"unknown model {model!r}: choose one of {MODELS}")
    full = dict(DEFAULT_GRIDS[model])
    for name, values in (grid or {}).items():
        name = name.removeprefix("model__")
        if name not in full:
            raise ValueError(f"{name}: not a parameter of {model!r}, which has {list(full)}")
        full[name] = list(values)
    for name, values in full.items():
        allowed, wording = MODEL_CHECKS.get((model, name), CHECKS[name])
        if not values:
            raise ValueError(f"{name}: give at least one value")
        for position, value in enumerate(values):
            if not allowed(value):
                raise ValueError(f"{name}={value!r} is not supported: must be {wording}")
            if value in values[:position]:
                raise ValueError(f"{name}={value!r} is listed twice")
    return full


def grid_points(model: str, grid: Mapping[str, Sequence] | None = None) -> list[dict]:
    """Every combination, keys in sorted order with the last one varying fastest."""
    full = check_grid(model, grid)
    axes = sorted(name for name in full if name not in NO_EFFECT)
    return [dict(zip(axes, values)) for values in product(*[full[name] for name in axes])]
