"""Column expressions behind the derived fields. All run inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(text: str | Column) -> Column:
    """``yyyy-MM-dd`` text as a date; other text raises under ANSI mode."""
    return F.to_date(text)


def promo_flag(count: str = "onpromotion") -> Column:
    """1 if any item was on promotion, else 0; an unknown count is 0."""
    return F.coalesce(F.col(count) > 0, F.lit(False)).cast("int")


def holiday_flag(holiday_type: str = "type") -> Column:
    """1 if a holiday row was joined, whatever its type."""
    return F.col(holiday_type).isNotNull().cast("int")


def month_day(date: str = "date") -> Column:
    """``MM-dd`` part of a date."""
    return F.substring(F.col(date).cast("string"), 6, 5)


def clip_at_zero(value: str = "sales") -> Column:
    """Negative values become 0; NULL stays NULL (``greatest`` would turn it into 0)."""
    return F.when(F.col(value) < 0, F.lit(0.0)).otherwise(F.col(value))
