import pytest
from pyspark.sql import functions as F

from sales_cases import column, day
from shelfcast.functions.columns import parse_date
from shelfcast.functions.dates import two_year_span, year_span
from shelfcast.operators.aggregates import daily_totals, r2, value_counts
from shelfcast.operators.filters import (
    clip_label, feature_frame, fill_zero, filter_date_range, filter_year, prediction_output, with_holiday_flag,
    with_month_day, with_promo_flag,
)


def test_promotion_flag(spark):
    df = with_promo_flag(spark.createDataFrame([(1, 0), (2, 3), (3, None)], "id int, onpromotion long"))
    assert column(df, "onpromotion", "id") == [0, 1, 0]


def test_holiday_flag(spark):
    df = with_holiday_flag(spark.createDataFrame([(1, None), (2, "Event")], "id int, type string"))
    assert column(df, "is_holiday", "id") == [0, 1]


def test_clip_keeps_null(spark):
    df = clip_label(spark.createDataFrame([(1, -5.0), (2, 0.0), (3, 7.0), (4, None)], "id int, sales double"))
    assert column(df, "sales", "id") == [0.0, 0.0, 7.0, None]


def test_month_day(spark):
    df = with_month_day(spark.createDataFrame([(day("2017-08-16"),), (day("2017-01-02"),)], "date date"))
    assert column(df, "monthday", "date") == ["01-02", "08-16"]


def test_parse_date(spark):
    df = spark.createDataFrame([("2013-01-05",), (None,)], "text string").select(parse_date("text").alias("date"))
    assert column(df, "date", F.desc("date")) == [day("2013-01-05"), None]


def days(spark, *texts):
    return spark.createDataFrame([(day(t),) for t in texts], "date date")


def test_year_filter_is_inclusive(spark):
    df = days(spark, "2013-12-31", "2014-01-01", "2014-12-31", "2015-01-01")
    assert column(filter_year(df, 2014), "date", "date") == [day("2014-01-01"), day("2014-12-31")]


def test_two_year_span(spark):
    df = days(spark, "2012-12-31", "2013-01-01", "2014-12-31", "2015-01-01")
    assert column(filter_date_range(df, *two_year_span(2013)), "date", "date") == [day("2013-01-01"), day("2014-12-31")]
    assert year_span(2013) == (day("2013-01-01"), day("2013-12-31"))


def test_bounds_may_be_text(spark):
    df = days(spark, "2013-01-01", "2013-06-01")
    assert filter_date_range(df, "2013-01-01", "2013-05-31").count() == 1


def test_feature_frame_columns(spark):
    df = spark.sql(
        "SELECT 1L id, 'A' family, 2 store_nbr, 1 onpromotion, 3.5D dcoilwtico, 0 is_holiday, 'x' more"
    )
    assert feature_frame(df).columns == ["family", "store_nbr", "onpromotion", "dcoilwtico", "is_holiday"]
    assert feature_frame(df, "id").columns[0] == "id"


def test_fill_zero_leaves_text(spark):
    df = spark.createDataFrame([(None, None)], "n double, t string")
    assert tuple(fill_zero(df, ["n", "t"]).first()) == (0.0, None)


def test_predictions_are_not_clipped(spark):
    df = spark.createDataFrame([(1, -3.0, "x")], "id long, prediction double, more string")
    assert [r.asDict() for r in prediction_output(df).collect()] == [{"id": 1, "sales": -3.0}]


def test_daily_totals_null_rules(spark):
    rows = [("2013-01-01", 5), ("2013-01-01", None), ("2013-01-02", None), (None, 9)]
    df = spark.createDataFrame([(t and day(t), n) for t, n in rows], "date date, transactions long")
    assert sorted(map(tuple, daily_totals(df).collect())) == [(day("2013-01-01"), 5), (day("2013-01-02"), 0)]


def test_value_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "family string")
    assert [tuple(r) for r in value_counts(df, "family").collect()] == [("c", 2), ("a", 1), ("b", 1)]


@pytest.mark.parametrize("pairs, expected", [
    ([(1.0, 1.0), (2.0, 2.0), (4.0, 3.0)], 1 - 1 / (14 / 3)),
    ([(2.0, 2.0), (2.0, 2.0)], 1.0),
    ([(2.0, 2.0), (2.0, 5.0)], 0.0),
])
def test_r2(spark, pairs, expected):
    df = spark.createDataFrame(pairs, "y double, p double")
    assert r2(df, "y", "p").first()["r2"] == pytest.approx(expected)
