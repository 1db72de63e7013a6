"""Transaction trend: date filter, daily totals, moving averages.

The filter comes before the window, so the averages warm up again at each range start.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from shelfcast.functions.dates import two_year_span, year_span
from shelfcast.operators.aggregates import daily_totals
from shelfcast.operators.filters import filter_date_range
from shelfcast.operators.windows import moving_averages


def daily_trend(transactions: DataFrame, start: date | str, end: date | str) -> DataFrame:
    return moving_averages(daily_totals(filter_date_range(transactions, start, end)))


def trend_for_year(transactions: DataFrame, year: int) -> DataFrame:
    return daily_trend(transactions, *year_span(year))


def trend_from_year(transactions: DataFrame, year: int) -> DataFrame:
    """The chosen year and the one after it."""
    return daily_trend(transactions, *two_year_span(year))
