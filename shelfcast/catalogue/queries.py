"""One query per capability, over the stand-in tables. Each takes (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.functions.columns import clip_at_zero, parse_date
from shelfcast.functions.dates import two_year_span, year_span
from shelfcast.ml.models import fit_model
from shelfcast.ml.params import grid_points
from shelfcast.ml.preprocess import (
    categorical_imputer,
    min_max,
    numeric_imputer,
    one_hot,
    one_hot_levels,
    preprocessor,
)
from shelfcast.ml.search import ROW_ORDER, best_result, score_report
from shelfcast.operators import charts
from shelfcast.operators.aggregates import daily_totals, r2
from shelfcast.operators.filters import (
    NUMERIC,
    clip_label,
    feature_frame,
    filter_year,
    with_holiday_flag,
    with_month_day,
    with_promo_flag,
)
from shelfcast.operators.joins import enrich, join_holidays, join_oil
from shelfcast.operators.ordering import assign_folds, sort_by_date
from shelfcast.plans.forecast import forecast
from shelfcast.plans.training import select_model, training_rows
from shelfcast.plans.trend import daily_trend, trend_for_year, trend_from_year
from shelfcast.session import materialize, new_shared_path
from shelfcast.sources import stand_ins
from shelfcast.sources.readers import read_holidays, read_oil, read_table, read_test, read_train, read_transactions
from shelfcast.sources.schemas import TRAIN
from shelfcast.sources.writers import write_predictions

YEAR = 1997
NEW_YEAR = 1998
TREE_GRID = {"max_depth": [2, 5], "max_features": ["sqrt", None]}
ALL_YEARS = (date(1995, 1, 1), date(2001, 12, 31))

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(name: str, digits: int) -> Column:
    return F.round(name, digits).alias(name)


def _year_train(spark: SparkSession, sf_dir: str, year: int = YEAR) -> DataFrame:
    return filter_year(stand_ins.train(spark, sf_dir, year_span(year)), year)


def _dimensions(spark: SparkSession, sf_dir: str, bounds: stand_ins.Bounds) -> tuple[DataFrame, DataFrame]:
    return stand_ins.oil(spark, sf_dir, bounds), stand_ins.holidays(spark, sf_dir, bounds)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_year_train(spark, sf_dir), *_dimensions(spark, sf_dir, year_span(YEAR)))


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(_year_train(spark, sf_dir), *_dimensions(spark, sf_dir, year_span(YEAR)), YEAR)


# Filters and projections


def parse_dates(spark, sf_dir):
    texts = stand_ins.transactions(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    return texts.select(F.col("date").alias("date_text"), parse_date("date").alias("date"), "store_nbr", "transactions")


def filter_year_train(spark, sf_dir):
    return _year_train(spark, sf_dir).withColumn("sales", F.round("sales", 2))


def filter_year_transactions(spark, sf_dir):
    return filter_year(stand_ins.transactions(spark, sf_dir, year_span(YEAR)), YEAR)


def promo_flag(spark, sf_dir):
    return with_promo_flag(stand_ins.train(spark, sf_dir)).select("id", "onpromotion")


def holiday_flag(spark, sf_dir):
    joined = join_holidays(stand_ins.train(spark, sf_dir), stand_ins.holidays(spark, sf_dir))
    return with_holiday_flag(joined).select("id", "type", "is_holiday")


def month_day(spark, sf_dir):
    return with_month_day(stand_ins.train(spark, sf_dir)).select("id", "date", "monthday")


def clip_sales(spark, sf_dir):
    return clip_label(stand_ins.train(spark, sf_dir)).select("id", _rounded("sales", 2))


def features(spark, sf_dir):
    return feature_frame(_enriched(spark, sf_dir))


# Joins


def oil_join(spark, sf_dir):
    joined = join_oil(stand_ins.train(spark, sf_dir), stand_ins.oil(spark, sf_dir))
    return joined.select("id", "date", "dcoilwtico")


def holiday_join(spark, sf_dir):
    joined = join_holidays(stand_ins.train(spark, sf_dir), stand_ins.holidays(spark, sf_dir))
    return joined.select("id", "date", "type")


def holiday_join_dedupe(spark, sf_dir):
    joined = join_holidays(stand_ins.train(spark, sf_dir), stand_ins.holidays(spark, sf_dir), dedupe=True)
    return joined.select("id", "date", "type")


def enrich_train(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "id", "date", "store_nbr", "family", _rounded("sales", 2), "onpromotion",
        "dcoilwtico", "type", "is_holiday",
    )


def enrich_test(spark, sf_dir):
    return enrich(stand_ins.test(spark, sf_dir), *_dimensions(spark, sf_dir, stand_ins.TEST_BOUNDS)).select(
        "id", "date", "store_nbr", "family", "onpromotion", "dcoilwtico", "type", "is_holiday"
    )


# Trend


def sorted_transactions(spark, sf_dir):
    return sort_by_date(stand_ins.transactions(spark, sf_dir), "store_nbr")


def daily_transactions(spark, sf_dir):
    return sort_by_date(daily_totals(stand_ins.transactions(spark, sf_dir)))


def _trend(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.endswith("_MA")})


def daily_ma_year(spark, sf_dir):
    return _trend(trend_for_year(stand_ins.transactions(spark, sf_dir, year_span(YEAR)), YEAR))


def daily_ma_span(spark, sf_dir):
    return _trend(trend_from_year(stand_ins.transactions(spark, sf_dir, two_year_span(YEAR)), YEAR))


def daily_ma_new_span(spark, sf_dir):
    return _trend(trend_from_year(stand_ins.transactions(spark, sf_dir, two_year_span(NEW_YEAR)), NEW_YEAR))


def daily_ma_all(spark, sf_dir):
    return _trend(daily_trend(stand_ins.transactions(spark, sf_dir, ALL_YEARS), *ALL_YEARS))


# Preprocessing, fitted on and applied to the enriched year. It is stored first, as each fit and the
# final projection read it again.


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(_enriched(spark, sf_dir), "enriched")


def _imputed(strategy: str) -> Query:
    def fill_rounded(name: str) -> Column:
        filled = F.col(f"filled_{name}")
        return F.when(F.col(name).isNull(), F.round(filled, 6)).otherwise(filled).alias(name)

    def query(spark, sf_dir):
        rows = _stored(spark, sf_dir)
        filled = numeric_imputer(strategy).fit(rows).transform(rows)
        return filled.select("id", "type", *[fill_rounded(c) for c in NUMERIC])

    return query


def impute_family(spark, sf_dir):
    """Families with PROMO taken as missing."""
    rows = _stored(spark, sf_dir).withColumn("family", F.nullif("family", F.lit("PROMO")))
    for strategy in ("most_frequent", "constant"):
        rows = categorical_imputer(strategy, prefix=f"{strategy}_").fit(rows).transform(rows)
    return rows.select("id", "type", "most_frequent_family", "constant_family")


def minmax_scale(spark, sf_dir):
    rows = _stored(spark, sf_dir)
    filled = numeric_imputer("mean").fit(rows).transform(rows)
    columns = [f"filled_{c}" for c in NUMERIC]
    scaled = min_max(columns, [f"scaled_{c}" for c in NUMERIC]).fit(filled).transform(filled)
    return scaled.select("id", "type", *[F.round(f"scaled_{c}", 6).alias(c) for c in NUMERIC])


def one_hot_family(spark, sf_dir):
    rows = _stored(spark, sf_dir)
    fitted = one_hot().fit(rows)
    slots = vector_to_array("onehot_family")
    return fitted.transform(rows).select(
        "id", "type", *[slots[i].cast("int").alias(f"family_{level}") for i, level in enumerate(one_hot_levels(fitted)[0])]
    )


def features_vector(spark, sf_dir):
    rows = _stored(spark, sf_dir)
    fitted = preprocessor().fit(rows)
    names = [*NUMERIC, *[f"family_{level}" for level in one_hot_levels(fitted.stages[3])[0]]]
    slots = vector_to_array("features")
    return fitted.transform(rows).select(
        "id", "type", *[F.round(slots[i], 6).alias(name) for i, name in enumerate(names)]
    )


# Models


def folds(spark, sf_dir):
    return assign_folds(_enriched(spark, sf_dir), ROW_ORDER).select("id", "type", "fold")


def r2_group_mean(spark, sf_dir):
    means = clip_label(_year_train(spark, sf_dir)).groupBy("family").agg(F.avg("sales").alias("mean_sales"))
    held_out = clip_label(_year_train(spark, sf_dir, NEW_YEAR)).select("family", "sales")
    return r2(held_out.join(means, "family"), "sales", "mean_sales").select(_rounded("r2", 6))


def _forecast(spark, sf_dir, fitted) -> DataFrame:
    return forecast(fitted, stand_ins.test(spark, sf_dir), *_dimensions(spark, sf_dir, stand_ins.TEST_BOUNDS))


def _predicted(model: str, digits: int | None = None, learner: str = "auto", **values) -> Query:
    """Fit on the year, predict the test table. ``values`` replace defaults of the grid point."""
    point = grid_points(model, {name: [value] for name, value in values.items()})[0]

    def query(spark, sf_dir):
        output = _forecast(spark, sf_dir, fit_model(_training(spark, sf_dir), model, point, learner=learner))
        return output if digits is None else output.withColumn("sales", F.round("sales", digits))

    return query


def _predicted_rows(model: str) -> Query:
    """Rows per id of a model with random parts, and how many lie in the range of the year's labels.

    Trees predict means of labels, so all do; boosting adds steps and may leave the range.
    """

    def query(spark, sf_dir):
        training = materialize(_training(spark, sf_dir), "training-rows")
        low, high = training.agg(F.min("label"), F.max("label")).first()
        output = _forecast(spark, sf_dir, fit_model(training, model))
        inside = F.col("sales").between(low - 1e-6, high + 1e-6)
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("sales").isNotNull()).alias("predicted")]
        if model != "gradient":
            counts.append(F.count_if(inside).alias("in_range"))
        return output.groupBy("id").agg(*counts)

    return query


def _searched(spark, sf_dir, model: str, grid: dict | None = None, **search):
    year = _year_train(spark, sf_dir), *_dimensions(spark, sf_dir, year_span(YEAR))
    return select_model(*year, YEAR, model, grid=grid, **search)


def grid_scores_linear_constant(spark, sf_dir):
    """Missing prices as 0 instead of the mean, missing families as a level of their own."""
    result = _searched(spark, sf_dir, "linear", num_strategy="constant", cat_strategy="constant")
    return score_report(spark, result).select("grid_point", "params", _rounded("mean_r2", 6))


def grid_points_tree(spark, sf_dir):
    """Grid points of ``grid_scores_tree`` with how many of them are the best one."""
    result = _searched(spark, sf_dir, "decision", TREE_GRID)
    report = score_report(spark, result)
    best = report.filter("best").count()
    return report.select("grid_point", "params", F.lit(best).cast("long").alias("best_points"))


def grid_scores_linear(spark, sf_dir):
    result = _searched(spark, sf_dir, "linear", {"fit_intercept": [True, False]})
    return score_report(spark, result).select("grid_point", "params", _rounded("mean_r2", 6))


def grid_scores_tree(spark, sf_dir):
    return score_report(spark, _searched(spark, sf_dir, "decision", TREE_GRID))


def grid_scores_full_tree(spark, sf_dir):
    """Trees that see every feature at every split, so that nothing is random."""
    result = _searched(spark, sf_dir, "decision", {"max_depth": [1, 2], "max_features": [None]})
    return score_report(spark, result).withColumn("mean_r2", F.round("mean_r2", 6))


def grid_scores_levels(spark, sf_dir):
    """The same by the learner that grows trees by levels."""
    result = _searched(spark, sf_dir, "decision", {"max_depth": [1, 2], "max_features": [None]}, learner="levels")
    return score_report(spark, result).withColumn("mean_r2", F.round("mean_r2", 6))


def best_linear(spark, sf_dir):
    return best_result(spark, _searched(spark, sf_dir, "linear")).select("params", _rounded("mean_r2", 6))


def csv_roundtrip(spark, sf_dir):
    """Family means as predictions, written to CSV and read back."""
    means = clip_label(_year_train(spark, sf_dir)).groupBy("family").agg(F.avg("sales").alias("sales"))
    path = new_shared_path(spark, "predictions")
    write_predictions(stand_ins.test(spark, sf_dir).join(means, "family"), path)
    back = read_table(spark, path, TRAIN, optional=set(TRAIN.names) - {"id", "sales"})
    return back.select("id", _rounded("sales", 6))


def csv_roundtrip_linear(spark, sf_dir):
    """Fit, forecast, write the predictions, read them back."""
    fitted = fit_model(_training(spark, sf_dir), "linear")
    path = new_shared_path(spark, "forecast")
    write_predictions(_forecast(spark, sf_dir, fitted), path)
    back = read_table(spark, path, TRAIN, optional=set(TRAIN.names) - {"id", "sales"})
    return back.select("id", _rounded("sales", 2))


def _read_back(table: Callable[[SparkSession, str], DataFrame], reader, *columns: str) -> Query:
    """A stand-in input written as CSV in several files and read by its reader."""

    def query(spark, sf_dir):
        path = new_shared_path(spark, "input")
        table(spark, sf_dir).write.option("header", True).csv(path)
        return reader(spark, path, "csv").selectExpr(*columns)

    return query


# Chart tables


def _features(spark, sf_dir) -> DataFrame:
    return feature_frame(_enriched(spark, sf_dir), *[c for c in ROW_ORDER if c not in ("store_nbr", "family")])


def scatter_transactions(spark, sf_dir):
    return charts.scatter_transactions(stand_ins.transactions(spark, sf_dir), "datetime", "store_nbr", "transactions")


def scatter_daily(spark, sf_dir):
    points = charts.scatter_daily(daily_ma_year(spark, sf_dir), "date", "transactions", "60_day_MA")
    return points.withColumn("z", F.round("z", 6))


def scatter_features(spark, sf_dir):
    return charts.scatter_features(_features(spark, sf_dir), "family", "store_nbr", "dcoilwtico")


def scatter_transactions_counts(spark, sf_dir):
    return charts.scatter_counts(charts.scatter_transactions(stand_ins.transactions(spark, sf_dir), "store_nbr", "store_nbr", "transactions"))


def scatter_transactions_grid(spark, sf_dir):
    points = charts.scatter_transactions(stand_ins.transactions(spark, sf_dir), "datetime", "store_nbr", "transactions")
    return charts.scatter_grid(points, 20).withColumns({axis: F.round(axis, 6) for axis in "yz"})


def scatter_features_grid(spark, sf_dir):
    return charts.scatter_grid(scatter_features(spark, sf_dir), 10).withColumns({axis: F.round(axis, 6) for axis in "yz"})


def bar_store_promo(spark, sf_dir):
    return charts.bar_data(_features(spark, sf_dir), "store_nbr", "onpromotion")


def line_store_promo(spark, sf_dir):
    return charts.line_data(_features(spark, sf_dir), "store_nbr", "onpromotion", *ROW_ORDER)


def line_store_oil_columns(spark, sf_dir):
    return charts.line_columns(_features(spark, sf_dir), "store_nbr", "dcoilwtico", *ROW_ORDER, columns=100)


def line_store_promo_summary(spark, sf_dir):
    return charts.line_summary(_features(spark, sf_dir), "store_nbr", "onpromotion").withColumn(
        "y_mean", F.round("y_mean", 6)
    )


def pie_family(spark, sf_dir):
    return charts.pie_data(_features(spark, sf_dir), "family")


def hist_store(spark, sf_dir):
    table = charts.histogram_data(_features(spark, sf_dir), "store_nbr", 10)
    return table.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


def hist_family(spark, sf_dir):
    return charts.histogram_data(_features(spark, sf_dir), "family")


def hist_family_missing(spark, sf_dir):
    """Families with PROMO taken as missing; they keep a bin of their own."""
    return charts.histogram_data(_features(spark, sf_dir).withColumn("family", F.nullif("family", F.lit("PROMO"))), "family")


def _box(column: str) -> Query:
    def query(spark, sf_dir):
        table = charts.box_data(_features(spark, sf_dir), column)
        return table.withColumns({c: F.round(c, 6) for c in table.columns if c != "outliers"})

    return query


def scale_label(spark, sf_dir):
    """Bounds learned from one year's sales, applied to the next: values may leave [0, 1]."""
    fit_on = _year_train(spark, sf_dir).select(clip_at_zero().alias("sales"))
    apply_to = clip_label(_year_train(spark, sf_dir, NEW_YEAR)).select("id", "sales")
    scaled = min_max(["sales"], ["scaled"]).fit(fit_on).transform(apply_to)
    return scaled.select("id", _rounded("scaled", 6))


QUERIES: dict[str, Query] = {
    "parse_dates": parse_dates,
    "filter_year_train": filter_year_train,
    "filter_year_transactions": filter_year_transactions,
    "promo_flag": promo_flag,
    "holiday_flag": holiday_flag,
    "month_day": month_day,
    "clip_sales": clip_sales,
    "feature_frame": features,
    "join_oil": oil_join,
    "join_holidays": holiday_join,
    "join_holidays_dedupe": holiday_join_dedupe,
    "enrich_train": enrich_train,
    "enrich_test": enrich_test,
    "sorted_transactions": sorted_transactions,
    "daily_transactions": daily_transactions,
    "daily_ma_year": daily_ma_year,
    "daily_ma_span": daily_ma_span,
    "daily_ma_new_span": daily_ma_new_span,
    "daily_ma_all": daily_ma_all,
    "impute_mean": _imputed("mean"),
    "impute_mode": _imputed("most_frequent"),
    "impute_constant": _imputed("constant"),
    "impute_family": impute_family,
    "minmax_scale": minmax_scale,
    "scale_label": scale_label,
    "one_hot_family": one_hot_family,
    "features_vector": features_vector,
    "assign_folds": folds,
    "r2_group_mean": r2_group_mean,
    "predict_linear": _predicted("linear", digits=2),
    "predict_tree": _predicted("decision", digits=2, max_depth=2, max_features=None),
    "predict_boosted_stumps": _predicted("gradient", digits=2, max_depth=1, max_features=None, n_estimators=2),
    "predict_boosted_trees": _predicted("gradient", digits=2, n_estimators=3),
    "predict_boosted_absolute": _predicted("gradient", digits=2, max_features=None, n_estimators=2, loss="absolute_error"),
    "predict_boosted_huber": _predicted("gradient", digits=2, max_features=None, n_estimators=2, loss="huber"),
    "predict_boosted_quantile": _predicted("gradient", digits=2, max_features=None, n_estimators=2, loss="quantile"),
    "predict_tree_levels": _predicted("decision", digits=2, learner="levels", max_depth=2, max_features=None),
    "predict_tree_sqrt": _predicted("decision", digits=2, learner="levels", max_depth=3),
    "predict_tree_poisson": _predicted("decision", digits=2, max_depth=2, max_features=None, criterion="poisson"),
    "predict_tree_median": _predicted("decision", digits=2, max_depth=2, max_features=None, criterion="absolute_error"),
    "predict_tree_random": _predicted("decision", digits=2, max_depth=3, max_features=None, splitter="random"),
    "predict_tree_stopped": _predicted(
        "decision", digits=2, max_depth=4, max_features=None, min_samples_split=400, min_impurity_decrease=500_000.0
    ),
    "predict_forest_trees": _predicted("randomforest", digits=2, learner="levels", n_estimators=3),
    "predict_decision": _predicted("decision"),
    "predict_forest": _predicted("randomforest"),
    "predict_gbt": _predicted("gradient"),
    "grid_scores_linear": grid_scores_linear,
    "grid_scores_tree": grid_scores_tree,
    "grid_scores_full_tree": grid_scores_full_tree,
    "grid_scores_levels": grid_scores_levels,
    "best_linear": best_linear,
    "csv_roundtrip": csv_roundtrip,
    "csv_roundtrip_linear": csv_roundtrip_linear,
    "predict_decision_rows": _predicted_rows("decision"),
    "predict_forest_rows": _predicted_rows("randomforest"),
    "predict_gbt_rows": _predicted_rows("gradient"),
    "grid_scores_linear_constant": grid_scores_linear_constant,
    "grid_points_tree": grid_points_tree,
    "read_train_csv": _read_back(
        stand_ins.train, read_train, "id", "date", "store_nbr", "family", "round(sales, 2) AS sales", "onpromotion"
    ),
    "read_test_csv": _read_back(stand_ins.test, read_test, "id", "date", "store_nbr", "family", "onpromotion"),
    "read_oil_csv": _read_back(stand_ins.oil, read_oil, "date", "dcoilwtico"),
    "read_holidays_csv": _read_back(stand_ins.holidays, read_holidays, "date", "type"),
    "read_transactions_csv": _read_back(stand_ins.transactions, read_transactions, "date", "store_nbr", "transactions"),
    "scatter_transactions": scatter_transactions,
    "scatter_daily": scatter_daily,
    "scatter_features": scatter_features,
    "scatter_transactions_counts": scatter_transactions_counts,
    "scatter_transactions_grid": scatter_transactions_grid,
    "scatter_features_grid": scatter_features_grid,
    "line_store_oil_columns": line_store_oil_columns,
    "bar_store_promo": bar_store_promo,
    "line_store_promo": line_store_promo,
    "line_store_promo_summary": line_store_promo_summary,
    "pie_family": pie_family,
    "hist_store": hist_store,
    "hist_family": hist_family,
    "hist_family_missing": hist_family_missing,
    "box_store": _box("store_nbr"),
    "box_oil": _box("dcoilwtico"),
}
