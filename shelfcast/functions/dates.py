"""Inclusive date bounds."""

from __future__ import annotations

from datetime import date


def year_span(year: int) -> tuple[date, date]:
    return date(year, 1, 1), date(year, 12, 31)


def two_year_span(year: int) -> tuple[date, date]:
    """Bounds of the trend chart for a chosen year, which also covers the year after it."""
    return date(year, 1, 1), date(year + 1, 12, 31)
