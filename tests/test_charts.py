import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sales_cases import day
from shelfcast.operators import charts


@pytest.fixture(scope="module")
def features(spark):
    rows = [("A", 1, 0, 1.0, 0), ("A", 2, 1, None, 0), ("B", 2, 1, 3.0, 1), ("B", 54, 1, 4.0, 0), (None, 3, 0, 2.0, 0)]
    return spark.createDataFrame(rows, "family string, store_nbr int, onpromotion int, dcoilwtico double, is_holiday int")


def rows(df, *order_by):
    return [tuple(r) for r in df.orderBy(*order_by).collect()]


def test_scatter_fills_numbers(features):
    points = charts.scatter_features(features.filter("store_nbr = 2"), "family", "store_nbr", "dcoilwtico")
    assert rows(points, "x") == [("A", 2, 0.0), ("B", 2, 3.0)]


def test_scatter_axes_may_repeat(features):
    assert rows(charts.scatter_features(features, "store_nbr", "store_nbr", "store_nbr"), "x")[0] == (1, 1, 1)


def test_scatter_merges_equal_points(features):
    points = charts.scatter_features(features, "onpromotion", "is_holiday", "is_holiday")
    assert rows(charts.scatter_counts(points), "x", "y") == [(0, 0, 0, 2), (1, 0, 0, 2), (1, 1, 1, 1)]


def test_scatter_grid_counts_every_row(spark, features):
    points = charts.scatter_features(features, "family", "store_nbr", "dcoilwtico")
    # stores 1, 2, 3 share the lower half of 1 to 54, prices 0, 1 that of 0 to 4
    assert rows(charts.scatter_grid(points, 2), "x", "y", "z") == [
        (None, 1.0, 2.0, 1), ("A", 1.0, 0.0, 2), ("B", 1.0, 2.0, 1), ("B", 27.5, 2.0, 1)
    ]
    days = spark.createDataFrame([(day(f"2017-01-{n:02}"), 1, n) for n in (1, 2, 3, 10, 11)] + [(None, 1, 1)], "x date, y int, z int")
    assert rows(charts.scatter_grid(days, 2), "x") == [
        (None, 1.0, 1.0, 1), (day("2017-01-01"), 1.0, 1.0, 3), (day("2017-01-06"), 1.0, 6.0, 2)
    ]
    assert charts.scatter_grid(days.limit(0), 3).collect() == []
    with pytest.raises(ValueError, match="cells"):
        charts.scatter_grid(days, 0)


def test_scatter_refusals(features):
    with pytest.raises(ValueError, match="family"):
        charts.scatter_features(features, "store_nbr", "onpromotion", "family")
    with pytest.raises(ValueError, match="nothing"):
        charts.scatter_features(features, "nothing", "onpromotion", "store_nbr")


def test_scatter_transactions_offers_datetime(spark):
    df = spark.createDataFrame([(day("2017-01-01"), 1, None)], "date date, store_nbr int, transactions long")
    assert rows(charts.scatter_transactions(df, "datetime", "store_nbr", "transactions"), "x") == [(day("2017-01-01"), 1, 0)]


def test_bar_sums(features):
    assert rows(charts.bar_data(features, "store_nbr", "onpromotion"), "x") == [(1, 0), (2, 2), (3, 0), (54, 1)]
    with pytest.raises(ValueError, match="not numeric"):
        charts.bar_data(features, "store_nbr", "family")


def test_bar_same_column_twice(features):
    assert rows(charts.bar_data(features, "store_nbr", "store_nbr"), "x") == [(1, 1), (2, 4), (3, 3), (54, 54)]


def test_line_keeps_order(features):
    assert [tuple(r) for r in charts.line_data(features, "store_nbr", "onpromotion", "store_nbr", "family").collect()] == [
        (1, 0), (2, 1), (2, 1), (3, 0), (54, 1)
    ]
    assert rows(charts.line_summary(features, "onpromotion", "dcoilwtico"), "x") == [
        (0, 1.0, 1.5, 2.0), (1, 0.0, 7 / 3, 4.0)
    ]


def test_line_columns_keep_ends_and_extremes(spark):
    values = [int(v) for v in np.random.default_rng(4).integers(0, 50, 1003)]
    df = spark.createDataFrame(list(enumerate(values)), "n int, v int").repartition(7)
    got = [tuple(r) for r in charts.line_columns(df, "n", "v", "n", columns=20).collect()]
    expected = []
    for column in range(20):
        own = [place for place in range(1003) if place * 20 // 1003 == column]
        lowest, highest = min(own, key=lambda p: (values[p], p)), max(own, key=lambda p: (values[p], -p))
        expected += [(column, place, place, values[place]) for place in sorted({own[0], own[-1], lowest, highest})]
    assert got == expected and len(got) <= 80


def test_line_columns_of_few_rows(spark):
    df = spark.createDataFrame([(2, None), (1, 5.0)], "n int, v double")
    assert [tuple(r) for r in charts.line_columns(df, "n", "v", "n", columns=100).collect()] == [(0, 0, 1, 5.0), (50, 1, 2, 0.0)]
    assert charts.line_columns(df.limit(0), "n", "v", "n").collect() == []


def test_pie_drops_missing(features):
    assert [tuple(r) for r in charts.pie_data(features, "family").collect()] == [("A", 2), ("B", 2)]


def test_histogram_numbers(features):
    table = rows(charts.histogram_data(features, "store_nbr", 4), "bin")
    assert [(t[0], t[3]) for t in table] == [(1, 4), (2, 0), (3, 0), (4, 1)]
    assert (table[0][1], table[-1][2]) == (1.0, 54.0)


def test_histogram_constant_and_text(spark, features):
    constant = spark.createDataFrame([(5,), (5,)], "n int")
    assert [t[3] for t in rows(charts.histogram_data(constant, "n", 3), "bin")] == [2, 0, 0]
    assert rows(charts.histogram_data(features, "family"), "value") == [(None, 1), ("A", 2), ("B", 2)]
    assert rows(charts.bar_data(features, "family", "store_nbr"), "x") == [(None, 3), ("A", 3), ("B", 56)]


def test_box_matches_numpy(spark):
    values = [1, 2, 2, 3, 4, 5, 6, 7, 8, 40, -30]
    df = spark.createDataFrame([(v,) for v in values], "n int")
    got = charts.box_data(df, "n").first()
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert tuple(got) == (min(inside), q1, median, q3, max(inside), 2)


def test_box_refuses_text(features):
    with pytest.raises(ValueError, match="not numeric"):
        charts.box_data(features, "family")


def test_box_of_nothing_and_of_one_value(spark):
    empty = charts.box_data(spark.createDataFrame([], "n int"), "n").first()
    assert tuple(empty) == (None, None, None, None, None, 0)
    assert tuple(charts.box_data(spark.createDataFrame([(5,)] * 3, "n int"), "n").first()) == (5, 5, 5, 5, 5, 0)


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.integers(-20, 20), min_size=1, max_size=40))
def test_box_quartiles_are_exact(spark, values):
    got = charts.box_data(spark.createDataFrame([(v,) for v in values], "n int").repartition(3), "n").first()
    assert [got["q1"], got["median"], got["q3"]] == pytest.approx(np.percentile(values, [25, 50, 75]).tolist())


def test_charts_gather_no_rows_in_one_task(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("int").alias("n"))
    for chart in (charts.histogram_data(df, "n"), charts.box_data(df, "n")):
        for part in chart._jdf.queryExecution().executedPlan().toString().split("Exchange SinglePartition")[1:]:
            assert "partial_" in part.splitlines()[1]
