"""Grid search with contiguous cross-validation folds."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from shelfcast.ml.models import bins_for, fit_prepared, predict
from shelfcast.ml.params import grid_points
from shelfcast.ml.preprocess import fit_per_fold
from shelfcast.operators.aggregates import r2_score
from shelfcast.operators.ordering import cut_folds, in_order
from shelfcast.session import materialized

# Sorted position of a training row. Equal holiday copies of a sale tie, and are equal rows.
ROW_ORDER = ["date", "store_nbr", "family", "type"]


@dataclass(frozen=True)
class SearchResult:
    best_model: PipelineModel
    best_params: dict
    best_score: float
    points: list[dict]
    fold_scores: list[list[float]]  # per grid point, per fold
    max_bins: int  # split candidates per feature that trees could use

    @property
    def mean_scores(self) -> list[float]:
        return [sum(scores) / len(scores) for scores in self.fold_scores]


def _score(
    train: DataFrame, valid: DataFrame, prepared: PipelineModel, model: str, point: dict, seed: int, max_bins: int,
    learner: str,
) -> float:
    """R2 on ``valid`` of one grid point fitted on ``train``."""
    fitted = fit_prepared(train, prepared, model, point, seed, max_bins, learner).stages[-1]
    scored = predict(fitted, prepared.transform(valid).select("features", "label"))
    return scored.agg(r2_score("label", "prediction")).first()[0]


def grid_search(
    df: DataFrame,
    model: str,
    grid: Mapping[str, Sequence] | None = None,
    num_strategy: str = "mean",
    cat_strategy: str = "most_frequent",
    folds: int = 5,
    parallelism: int = 5,
    seed: int = 42,
    order_by: Sequence[str] = ROW_ORDER,
    max_bins: int | None = None,
    learner: str = "auto",
) -> SearchResult:
    """Fits every grid point on every fold, picks the best mean R2 and refits it on all rows.

    ``df`` has the feature columns, ``label`` and the ``order_by`` columns. Folds are contiguous in
    that order, and the preprocessor never sees the held-out one. The first grid point wins a tie.
    A failing fit raises. ``parallelism`` is the number of fits, of any fold and point, worked on at
    the same time. ``max_bins`` and ``learner`` are as in ``fit_model``. The sorted rows are stored for the time of
    the search only.
    """
    points = grid_points(model, grid)
    with materialized(in_order(df, order_by), "folds") as stored:
        cut = cut_folds(stored, folds)
        *per_fold, on_all = fit_per_fold(cut.rows(), folds, num_strategy, cat_strategy)
        bins = bins_for(model, stored, max_bins)

        def score(pair: tuple[int, int]) -> float:
            fold, point = pair
            return _score(cut.others(fold), cut.held_out(fold), per_fold[fold], model, points[point], seed, bins, learner)

        pairs = [(fold, point) for point in range(len(points)) for fold in range(folds)]
        with ThreadPool(min(parallelism, len(pairs))) as pool:
            scores = pool.map(inheritable_thread_target(df.sparkSession)(score), pairs, chunksize=1)
        fold_scores = [scores[begin:begin + folds] for begin in range(0, len(scores), folds)]
        means = [sum(values) / folds for values in fold_scores]
        best = max(range(len(points)), key=means.__getitem__)
        refit = fit_prepared(cut.rows(), on_all, model, points[best], seed, bins, learner)
    return SearchResult(refit, points[best], means[best], points, fold_scores, bins)


def score_report(spark: SparkSession, result: SearchResult) -> DataFrame:
    """One row per grid point: parameters as JSON, mean score, and whether it was chosen."""
    rows = [
        (number, json.dumps(point, sort_keys=True), mean, point is result.best_params)
        for number, (point, mean) in enumerate(zip(result.points, result.mean_scores))
    ]
    return spark.createDataFrame(rows, "grid_point int, params string, mean_r2 double, best boolean")


def best_result(spark: SparkSession, result: SearchResult) -> DataFrame:
    """One row: best parameters and best mean score."""
    return score_report(spark, result).filter("best").select("params", "mean_r2")
