"""What the physical plans must look like."""

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.aggregates import daily_totals
from shelfcast.operators.charts import bar_data
from shelfcast.operators.filters import feature_frame, filter_year
from shelfcast.operators.joins import enrich
from shelfcast.operators.windows import moving_averages
from shelfcast.plans.trend import trend_for_year
from shelfcast.sources.readers import read_holidays, read_oil, read_train, read_transactions


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    date = F.date_add(F.lit("2016-06-01").cast("date"), (F.col("id") % 500).cast("int"))
    ids = spark.range(2000)
    ids.select("id", date.alias("date"), F.lit(1).alias("store_nbr"), F.lit("A").alias("family"),
               F.lit(1.0).alias("sales"), F.lit(0).cast("long").alias("onpromotion")).write.parquet(f"{folder}/train.parquet")
    ids.select(date.alias("date"), F.lit(1).alias("store_nbr"), F.col("id").alias("transactions")).write.parquet(
        f"{folder}/transactions.parquet")
    ids.limit(500).select(date.alias("date"), F.lit(50.0).alias("dcoilwtico")).write.parquet(f"{folder}/oil.parquet")
    ids.limit(20).select(date.alias("date"), F.lit("Event").alias("type")).write.parquet(f"{folder}/holidays.parquet")
    return {
        "train": read_train(spark, f"{folder}/train.parquet"),
        "transactions": read_transactions(spark, f"{folder}/transactions.parquet"),
        "oil": read_oil(spark, f"{folder}/oil.parquet"),
        "holidays": read_holidays(spark, f"{folder}/holidays.parquet"),
    }


def test_year_filter_reaches_the_scan(tables):
    text = plan(filter_year(tables["train"], 2017))
    assert "GreaterThanOrEqual(date,2017-01-01)" in text and "LessThanOrEqual(date,2017-12-31)" in text


def test_enrichment_broadcasts_and_does_not_shuffle_sales(tables):
    text = plan(feature_frame(enrich(filter_year(tables["train"], 2017), tables["oil"], tables["holidays"])))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    sales_side = text[: text.index("BroadcastExchange")]
    assert "FileScan parquet" in sales_side and "Exchange" not in sales_side
    assert "GreaterThanOrEqual(date,2017-01-01)" in sales_side
    scan = next(line for line in sales_side.splitlines() if "FileScan" in line)
    assert "sales" not in scan.split("ReadSchema")[1]


def test_all_averages_share_one_window_and_one_sort(tables):
    text = plan(trend_for_year(tables["transactions"], 2017))
    assert text.count("Window [") + text.count("Window(") == 1 and text.count("Sort [") == 1
    assert "partial_sum" in text
    assert "GreaterThanOrEqual(date,2017-01-01)" in text


def test_bar_aggregates_before_the_shuffle(tables):
    text = plan(bar_data(tables["train"], "store_nbr", "onpromotion"))
    assert "partial_sum" in text and text.count("Exchange hashpartitioning") == 1


def test_daily_series_is_summed_before_the_single_partition_window(tables):
    text = plan(moving_averages(daily_totals(tables["transactions"])))
    assert text.index("Exchange SinglePartition") < text.index("partial_sum")


def test_no_python_in_the_plans(tables):
    df = feature_frame(enrich(tables["train"], tables["oil"], tables["holidays"]))
    assert "Python" not in plan(df) and "Arrow" not in plan(df)
