import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sales_cases import column
from shelfcast.ml.preprocess import (
    categorical_imputer, fit_per_fold, min_max, numeric_imputer, one_hot, one_hot_levels, preprocessor,
)

NAN = float("nan")


def numbers(spark, values, kind="int"):
    return spark.createDataFrame(list(enumerate(values)), f"id int, n {kind}")


@pytest.mark.parametrize("strategy, values, kind, fill", [
    ("mean", [1, 2, 2, None], "int", 5 / 3),
    ("most_frequent", [2, 1, 1, 2, None], "int", 1.0),
    ("most_frequent", [3.0, 2.5, 3.0, NAN], "double", 3.0),
    ("mean", [1.0, NAN, 3.0, None], "double", 2.0),
    ("constant", [4, None], "int", 0.0),
    ("mean", [None, None], "double", 0.0),
    ("most_frequent", [None, None], "double", 0.0),
])
def test_numeric_fill(spark, strategy, values, kind, fill):
    df = numbers(spark, values, kind)
    filled = numeric_imputer(strategy, ["n"]).fit(df).transform(df)
    want = [fill if v is None or v != v else float(v) for v in values]
    assert column(filled, "filled_n", "id") == pytest.approx(want)


@pytest.mark.parametrize("strategy, fill", [("most_frequent", "a"), ("constant", "missing_value")])
def test_text_fill(spark, strategy, fill):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, family string")
    filled = categorical_imputer(strategy).fit(df).transform(df)
    assert column(filled, "filled_family", "id") == ["b", "a", "b", "a", fill]


def test_fill_is_learned_from_the_fitted_rows(spark):
    model = numeric_imputer("mean", ["n"]).fit(numbers(spark, [10, 20]))
    assert column(model.transform(numbers(spark, [None])), "filled_n") == [15.0]


def test_strategies_are_checked(spark):
    with pytest.raises(ValueError, match="median"):
        numeric_imputer("median")
    with pytest.raises(ValueError, match="mean"):
        categorical_imputer("mean")
    with pytest.raises(ValueError, match="mix"):
        numeric_imputer("constant", ["id", "t"]).fit(spark.createDataFrame([(1, "a")], "id int, t string"))


def test_scaling(spark):
    model = min_max(["n"]).fit(numbers(spark, [2, 4, 6]))
    assert column(model.transform(numbers(spark, [2, 4, 6, 8])), "scaled_n", "id") == [0.0, 0.5, 1.0, 1.5]


def test_constant_column_scales_to_zero(spark):
    model = min_max(["n"]).fit(numbers(spark, [3, 3]))
    assert column(model.transform(numbers(spark, [3, 4])), "scaled_n", "id") == [0.0, 1.0]


def families(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "family string")


def test_one_hot_keeps_all_levels_sorted(spark):
    df = families(spark, "b", "c", "a", "c")
    model = one_hot().fit(df)
    assert one_hot_levels(model) == [["a", "b", "c"]]
    got = model.transform(df).select("family", vector_to_array("onehot_family").alias("v"))
    assert column(got, "v", "family") == [[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 1]]


def test_unseen_family_is_an_error(spark):
    model = one_hot().fit(families(spark, "a", "b"))
    with pytest.raises(Exception, match="Unseen label"):
        model.transform(families(spark, "z")).collect()


def rows(spark):
    return spark.createDataFrame(
        [("b", 1, 0, 10.0, 0), ("a", 3, 1, None, 0), ("b", 5, 1, 30.0, 0)],
        "family string, store_nbr int, onpromotion int, dcoilwtico double, is_holiday int",
    )


def test_preprocessor_layout_and_reload(spark, tmp_path):
    df = rows(spark)
    model = preprocessor().fit(df)
    want = [[0, 0, 0, 0, 0, 1], [0.5, 1, 0.5, 0, 1, 0], [1, 1, 1, 0, 0, 1]]
    for fitted in (model, _reloaded(model, tmp_path)):
        out = fitted.transform(df).withColumn("v", vector_to_array("features"))
        assert column(out, "v", "store_nbr") == want
        assert out.schema["features"].metadata["ml_attr"]["num_attrs"] == 6


def _reloaded(model, tmp_path):
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def test_mode_counts_do_not_pull_a_column_into_one_task(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("double").alias("n"))
    assert numeric_imputer("most_frequent", ["n"]).fit(df).getOrDefault("fills") == [7.0]


@pytest.mark.parametrize("num_strategy", ["mean", "most_frequent", "constant"])
@pytest.mark.parametrize("cat_strategy", ["most_frequent", "constant"])
def test_fits_per_fold_equal_separate_fits(spark, num_strategy, cat_strategy):
    data = [
        ("b", 1, 0, 10.0, 0, 0), (None, 3, 1, None, 0, 0), ("a", 5, 1, NAN, 0, 1), ("b", 2, 0, 70.0, 0, 1),
        ("c", 9, 0, None, 1, 2), ("a", 9, 1, 20.0, 0, 2), ("a", 4, 1, 10.0, 0, 0), (None, 1, 1, 20.0, 0, 1),
    ]
    df = spark.createDataFrame(
        data, "family string, store_nbr int, onpromotion int, dcoilwtico double, is_holiday int, fold int"
    )
    models = fit_per_fold(df, 3, num_strategy, cat_strategy)
    for fold, model in zip([0, 1, 2, None], models, strict=True):
        train = df if fold is None else df.filter(F.col("fold") != fold)
        separate = preprocessor(num_strategy, cat_strategy).fit(train)
        assert model.stages[0].getOrDefault("fills") == pytest.approx(separate.stages[0].getOrDefault("fills"))
        for name in ("lows", "highs"):
            assert model.stages[1].getOrDefault(name) == pytest.approx(separate.stages[1].getOrDefault(name))
        assert model.stages[2].getOrDefault("fills") == separate.stages[2].getOrDefault("fills")
        assert one_hot_levels(model.stages[3]) == one_hot_levels(separate.stages[3])
        vectors = [
            [tuple(v) for v in column(m.transform(train).select(vector_to_array("features").alias("v"), "store_nbr", "family"), "v", "store_nbr", "family")]
            for m in (model, separate)
        ]
        assert vectors[0] == [pytest.approx(v) for v in vectors[1]]
