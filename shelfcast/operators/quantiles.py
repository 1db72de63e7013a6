"""Running totals and quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfcast.session import materialized


@contextmanager
def running_totals(counts: DataFrame, by: Sequence[str], value: str, rows: str = "rows") -> Iterator[DataFrame]:
    """``counts`` with ``before`` and ``total``: the rows of smaller values in the group, and all its rows.

    ``counts`` has one row per group ``by`` and ``value``. It is sorted over all tasks and stored for
    the length of the block; what a task has of a group is added up in that task and offset by what
    earlier tasks have, so no group has to fit one task.
    """
    ordered = counts.repartitionByRange(*by, value).withColumn("task", F.spark_partition_id())
    with materialized(ordered, "running-totals") as stored:
        earlier = W.partitionBy(*by).orderBy("task").rowsBetween(W.unboundedPreceding, -1)
        in_tasks = stored.groupBy("task", *by).agg(F.sum(rows).alias("in_task")).select(
            "task", *by, F.coalesce(F.sum("in_task").over(earlier), F.lit(0)).alias("earlier"),
            F.sum("in_task").over(W.partitionBy(*by)).alias("total"),
        )
        within = W.partitionBy("task", *by).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
        running = stored.withColumn("within", F.coalesce(F.sum(rows).over(within), F.lit(0)))
        yield running.join(in_tasks, ["task", *by]).select(
            *counts.columns, (F.col("earlier") + F.col("within")).alias("before"), "total"
        )


def value_at(position: Column, value: str, rows: str = "rows") -> Column:
    """Aggregate of ``running_totals``: the value of the row at a position of the sorted group."""
    return F.min(F.when(F.col("before") + F.col(rows) > position, F.col(value)))


def interpolated(share: float, value: str, rows: str = "rows") -> Column:
    """Aggregate of ``running_totals``: the value at a share of the sorted group's rows, interpolated
    linearly between neighbouring rows."""
    at = F.lit(share) * (F.col("total") - 1)
    low, high = value_at(F.floor(at), value, rows), value_at(F.least(F.floor(at) + 1, F.col("total") - 1), value, rows)
    return low + F.max(at - F.floor(at)) * (high - low)


def group_quantiles(df: DataFrame, by: Sequence[str], value: str, share: float, copies: str | None = None) -> list:
    """Rows of ``by`` and ``quantile``, one per group of ``df``; equal values are merged first.

    A row stands for ``copies`` rows if such a column is named.

    The groups' results come to the driver: for groups that are few, like the leaves of a tree.
    """
    number = F.sum(F.col(copies).cast("long")) if copies else F.count(F.lit(1))
    counts = df.groupBy(*by, value).agg(number.alias("rows"))
    with running_totals(counts, by, value) as running:
        return running.groupBy(*by).agg(interpolated(share, value).alias("quantile")).collect()
