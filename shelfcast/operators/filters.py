"""Date filters and feature projections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.columns import clip_at_zero, holiday_flag, month_day, promo_flag
from shelfcast.functions.dates import year_span

NUMERIC = ["store_nbr", "onpromotion", "dcoilwtico", "is_holiday"]
# The feature columns.
CATEGORICAL = ["family"]


def filter_date_range(df: DataFrame, start: date | str, end: date | str, date_col: str = "date") -> DataFrame:
    """Rows dated from ``start`` to ``end``, both included.

    Compares the bare column with literals, so the filter reaches the Parquet scan (row group and
    partition pruning). ``year(date) = y`` would not.
    """
    return df.filter(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def filter_year(df: DataFrame, year: int, date_col: str = "date") -> DataFrame:
    return filter_date_range(df, *year_span(year), date_col=date_col)


def with_promo_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("onpromotion", promo_flag())


def with_holiday_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_holiday", holiday_flag())


def with_month_day(df: DataFrame) -> DataFrame:
    return df.withColumn("monthday", month_day())


def clip_label(df: DataFrame) -> DataFrame:
    return df.withColumn("sales", clip_at_zero())


def feature_frame(df: DataFrame, *keep: str | Column) -> DataFrame:
    """The model's columns: family, then the four numerics. ``keep`` adds columns in front."""
    return df.select(*keep, *CATEGORICAL, *NUMERIC)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing numbers become 0 in ``columns``; texts and dates stay as they are."""
    return df.fillna(0, subset=columns)


def prediction_output(predictions: DataFrame) -> DataFrame:
    """``id`` and the raw prediction as ``sales``. Predictions are not clipped at zero."""
    return predictions.select("id", F.col("prediction").alias("sales"))
