"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def daily_totals(df: DataFrame, value: str = "transactions") -> DataFrame:
    """Sum of ``value`` per date over all stores; a date with only missing values sums to 0."""
    return (
        df.filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(F.coalesce(F.sum(value), F.lit(0)).alias(value))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``category, count`` of the non-missing values, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("category"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "category")
    )


def r2_score(label: str, prediction: str) -> Column:
    """Aggregate expression 1 - SSres / SStot.

    With a constant label it is 1 for a perfect fit and 0 otherwise.
    """
    residual = F.sum(F.pow(F.col(label) - F.col(prediction), 2))
    total = F.var_pop(F.when(F.col(prediction).isNotNull(), F.col(label))) * F.count(
        F.col(label) - F.col(prediction)
    )
    return F.when(total > 0, 1 - residual / F.nullif(total, F.lit(0.0))).otherwise(
        F.when(residual == 0, 1.0).otherwise(0.0)
    )


def r2(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(r2_score(label, prediction).alias("r2"))
