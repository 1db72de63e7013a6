import datetime

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sales_cases import column, day
from shelfcast.operators.windows import moving_averages
from shelfcast.plans.trend import daily_trend, trend_for_year, trend_from_year


def series(spark, values, start="2017-01-01", skip=()):
    first = day(start)
    dates = [first + datetime.timedelta(days=i) for i in range(len(values) + len(skip)) if i not in skip]
    return spark.createDataFrame(list(zip(dates, values)), "date date, transactions long")


def test_frame_counts_rows_not_days(spark):
    df = moving_averages(series(spark, [1, 2, 3, 4, 5, 6, 7], skip=(4,)))
    assert column(df, "7_day_MA", "date") == [None] * 6 + [4.0]


def test_short_series_has_no_average(spark):
    df = moving_averages(series(spark, [1] * 6))
    assert all(row[2:] == (None,) * 4 for row in df.collect())


def test_null_value_blanks_its_frames(spark):
    df = moving_averages(series(spark, [1, None, 3, 4, 5]), windows=(2,))
    assert column(df, "2_day_MA", "date") == [None, None, None, 3.5, 4.5]


def test_averages_warm_up_at_each_range_start(spark):
    df = series(spark, list(range(40)), start="2016-12-12").withColumn("store_nbr", F.lit(1))
    year = trend_for_year(df, 2017)
    assert column(year, "7_day_MA", "date")[:7] == [None] * 6 + [23.0]
    whole = daily_trend(df, "2016-01-01", "2017-12-31")
    assert column(whole.filter("date = '2017-01-01'"), "7_day_MA") == [17.0]
    assert trend_from_year(df, 2016).count() == 40


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 10_000)), max_size=90, unique_by=lambda pair: pair[0]))
def test_matches_pandas_rolling(spark, pairs):
    rows = sorted((day("2017-01-01") + datetime.timedelta(days=d), n) for d, n in pairs)
    df = moving_averages(spark.createDataFrame(rows, "date date, transactions long"))
    expected = pd.Series([n for _, n in rows], dtype="float64")
    for n in (7, 14, 30, 60):
        got = column(df, f"{n}_day_MA", "date")
        want = [None if pd.isna(v) else v for v in expected.rolling(window=n).mean()]
        assert got == [v if v is None else pytest.approx(v) for v in want]
