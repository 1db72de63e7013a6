"""Moving averages over the daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

WINDOWS = (7, 14, 30, 60)


def moving_averages(
    daily: DataFrame, value: str = "transactions", windows: Sequence[int] = WINDOWS, order: str = "date"
) -> DataFrame:
    """Adds ``<n>_day_MA``: the mean of the last n rows, NULL until n values exist.

    Frames count rows, not days, so a missing date is skipped. The window has no partition key and
    runs in one task; its input is a daily series, at most one row per calendar date, whatever the
    size of the table it was summed from. All averages share one sort.
    """

    def average(n: int):
        frame = Window.orderBy(order).rowsBetween(1 - n, 0)
        return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))

    return daily.withColumns({f"{n}_day_MA": average(n) for n in windows})
