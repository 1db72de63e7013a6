import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from sales_cases import column, day
from shelfcast.ml.models import fit_model, predict
from shelfcast.ml.params import grid_points
from shelfcast.ml.search import best_result, grid_search, score_report
from shelfcast.plans.forecast import forecast
from shelfcast.plans.training import select_model, training_rows

SCHEMA = ("date date, store_nbr int, family string, type string, onpromotion int, dcoilwtico double, "
          "is_holiday int, label double")


@pytest.fixture(scope="module")
def rows(spark):
    """Half a year of feature rows whose label is linear in the features, plus noise."""
    rng = np.random.default_rng(0)
    data = []
    for i in range(180):
        date = day("2017-01-01") + datetime.timedelta(days=i)
        oil = None if i % 7 == 0 else 50 + float(rng.normal())
        for store, family in ((1, "A"), (4, "B"), (9, "C")):
            promo, holiday = int(rng.integers(2)), int(i % 30 == 0)
            label = 10 * store + 3 * promo + (oil or 50) + 20 * holiday + ord(family) + float(rng.normal())
            data.append((date, store, family, "Event" if holiday else None, promo, oil, holiday, label))
    return spark.createDataFrame(data, SCHEMA).repartition(4)


def design(frame):
    oil = frame["dcoilwtico"].fillna(frame["dcoilwtico"].mean())
    columns = [frame["store_nbr"], frame["onpromotion"], oil, frame["is_holiday"]]
    return np.column_stack([*columns, *[frame["family"] == f for f in "ABC"], np.ones(len(frame))]).astype(float)


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("drop", ["", "is_holiday = 0"])
def test_linear_equals_least_squares(rows, intercept, drop):
    """Also with a constant column, which makes the equations singular."""
    rows = rows.filter(drop) if drop else rows
    fitted = fit_model(rows, "linear", {"fit_intercept": intercept})
    frame = predict(fitted, rows).toPandas()
    x = design(frame)
    solution = np.linalg.lstsq(x, frame["label"], rcond=None)[0]
    assert frame["prediction"].to_numpy() == pytest.approx(x @ solution, abs=1e-3)


def test_deep_tree_reproduces_a_function_of_the_features(rows):
    exact = rows.withColumn("label", F.col("store_nbr") * 10.0 + F.col("onpromotion") * 3)
    params = grid_points("decision", {"max_features": [None]})[0]
    out = predict(fit_model(exact, "decision", params), exact)
    assert out.filter(F.abs(F.col("label") - F.col("prediction")) > 1e-9).count() == 0


@pytest.mark.parametrize("model, grid", [
    ("randomforest", {"n_estimators": [5], "max_depth": [3]}),
    ("gradient", {"n_estimators": [5], "max_depth": [2]}),
    ("gradient", {"n_estimators": [6], "loss": ["absolute_error"], "max_features": [None], "learning_rate": [0.3]}),
    ("gradient", {"n_estimators": [6], "loss": ["huber"], "max_features": [None], "learning_rate": [0.3]}),
    ("decision", {"splitter": ["random"], "max_depth": [6]}),
])
def test_ensembles_learn_and_repeat_with_a_seed(rows, model, grid):
    one = rows.coalesce(1).sortWithinPartitions("date", "store_nbr")
    params = grid_points(model, grid)[0]
    first, second = (
        column(predict(fit_model(one, model, params, seed=7), one), "prediction", "date", "store_nbr") for _ in range(2)
    )
    assert first == second
    labels = np.array(column(one, "label", "date", "store_nbr"))
    assert ((labels - np.array(first)) ** 2).sum() < 0.5 * ((labels - labels.mean()) ** 2).sum()


def test_boosting_starts_from_the_mean_and_shrinks_every_tree(spark):
    """Stumps on residuals -53, -49, 47, 55 of the mean 53, then on what half of the first leaves over."""
    df = spark.createDataFrame(
        [(0, 0, 0.0), (0, 1, 4.0), (1, 0, 100.0), (1, 1, 108.0)], "store_nbr int, onpromotion int, label double"
    ).selectExpr("*", "'A' AS family", "1D AS dcoilwtico", "0 AS is_holiday")
    params = grid_points("gradient", {"n_estimators": [2], "max_depth": [1], "max_features": [None], "learning_rate": [0.5]})[0]
    out = predict(fit_model(df, "gradient", params), df)
    assert column(out, "prediction", "store_nbr", "onpromotion") == pytest.approx([14.75, 14.75, 91.25, 91.25])


def test_search_picks_the_best_mean_score(spark, rows):
    result = grid_search(rows, "decision", {"max_depth": [1, 4], "max_features": [None]})
    assert [p["max_depth"] for p in result.points] == [1, 4]
    assert all(len(scores) == 5 for scores in result.fold_scores)
    assert result.best_score == max(result.mean_scores)
    assert result.best_params["max_depth"] == 4
    assert result.best_model.stages[-1].trees[0].depth == 4
    assert [r["best"] for r in score_report(spark, result).orderBy("grid_point").collect()] == [False, True]
    best = best_result(spark, result).collect()
    assert len(best) == 1 and '"max_depth": 4' in best[0]["params"]


def test_first_grid_point_wins_a_tie(rows):
    flat = rows.withColumn("label", F.col("onpromotion").cast("double"))
    result = grid_search(flat, "decision", {"max_depth": [3, 2], "max_features": [None]}, folds=3)
    assert result.mean_scores == [1.0, 1.0]
    assert result.best_params["max_depth"] == 3


def test_search_scores_equal_a_hand_made_cross_validation(rows):
    frame = rows.toPandas().sort_values(["date", "store_nbr", "family"]).reset_index(drop=True)
    scores = []
    for held in np.array_split(np.arange(len(frame)), 5):
        train, test = frame.drop(held), frame.loc[held]
        mean = train["dcoilwtico"].mean()
        x, xt = (design(part.assign(dcoilwtico=part["dcoilwtico"].fillna(mean))) for part in (train, test))
        residual = test["label"] - xt @ np.linalg.lstsq(x, train["label"], rcond=None)[0]
        scores.append(1 - (residual**2).sum() / ((test["label"] - test["label"].mean()) ** 2).sum())
    result = grid_search(rows, "linear")
    assert result.fold_scores[0] == pytest.approx(scores, abs=1e-6)
    assert result.best_score == pytest.approx(np.mean(scores), abs=1e-6)


def test_failing_fit_raises(spark, rows):
    """A family that only the held-out fold has cannot be encoded."""
    late = rows.filter("date > '2017-06-15'").withColumn("family", F.lit("Z"))
    with pytest.raises(Exception, match="Unseen label"):
        grid_search(rows.filter("date <= '2017-05-15'").union(late), "linear")


def test_bad_grid_starts_no_job(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    with pytest.raises(ValueError, match="criterion"):
        grid_search(rows, "decision", {"criterion": ["gini"]})
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_train_select_forecast(spark):
    dates = [day("2017-01-01") + datetime.timedelta(days=i) for i in range(60)]
    train = spark.createDataFrame(
        [(i, d, s, f, float(s * 10 + i % 5 - 20), i % 2) for i, d in enumerate(dates) for s, f in ((1, "A"), (5, "B"))]
        + [(999, day("2016-05-05"), 1, "OLD", 1e9, 0)],
        "id long, date date, store_nbr int, family string, sales double, onpromotion long",
    )
    test = spark.createDataFrame(
        [(1, day("2018-01-01"), 1, "A", 0), (2, day("2018-01-02"), 5, "B", 1)],
        "id long, date date, store_nbr int, family string, onpromotion long",
    )
    oil = spark.createDataFrame([(d, 50.0) for d in dates[::2]], "date date, dcoilwtico double")
    holidays = spark.createDataFrame(
        [(dates[3], "Event"), (dates[3], "Holiday"), (day("2018-01-02"), "Event"), (day("2018-01-02"), "Holiday")],
        "date date, type string",
    )
    training = training_rows(train, oil, holidays, 2017)
    assert training.count() == 122
    assert training.filter("label < 0").count() == 0
    result = select_model(train, oil, holidays, 2017, "linear", folds=3)
    output = forecast(result.best_model, test, oil, holidays)
    assert output.columns == ["id", "sales"]
    assert column(output, "id", "id") == [1, 2, 2]
    assert column(forecast(result.best_model, test, oil, holidays, dedupe=True), "id", "id") == [1, 2]


def test_trees_split_between_all_stores(spark):
    """600 stores with a label of their own each: a full tree reproduces every row."""
    rows = spark.range(600).select(
        F.lit("A").alias("family"), F.col("id").cast("int").alias("store_nbr"), F.lit(0).alias("onpromotion"),
        F.lit(50.0).alias("dcoilwtico"), F.lit(0).alias("is_holiday"), (F.col("id") * 3).cast("double").alias("label"),
    )
    point = grid_points("decision", {"max_features": [None]})[0]
    missed = predict(fit_model(rows, "decision", point), rows).filter("abs(prediction - label) > 1e-6").count()
    assert missed == 0
    coarse = fit_model(rows, "decision", point, max_bins=32)
    assert predict(coarse, rows).filter("abs(prediction - label) > 1e-6").count() > 0
