"""Helpers of the tests on tables."""

import datetime


def day(text: str) -> datetime.date:
    return datetime.date.fromisoformat(text)


def column(df, name, *order_by):
    return [row[name] for row in (df.orderBy(*order_by) if order_by else df).collect()]
