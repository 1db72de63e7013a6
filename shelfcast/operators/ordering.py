"""Row order: sorted output and contiguous folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.operators.copies import merge_copies, repeat_copies
from shelfcast.session import materialize


def sort_by_date(df: DataFrame, *ties: str) -> DataFrame:
    """Ascending by date; ``ties`` make the order total."""
    return df.orderBy("date", *ties)


def fold_starts(rows: int, folds: int) -> list[int]:
    """First row position of every fold but the first; the first ``rows % folds`` folds get one more."""
    if folds < 2:
        raise ValueError("folds must be at least 2")
    if rows < folds:
        raise ValueError(f"cannot cut {rows} rows into {folds} folds")
    small, longer = divmod(rows, folds)
    return list(accumulate(small + (fold < longer) for fold in range(folds - 1)))


def _cuts(task_rows: list[tuple[int, int]], folds: int) -> list[tuple[int, int]]:
    """(task, position) of the first row of every fold but the first."""
    cuts, before = [], 0
    tasks = iter(task_rows)
    current, rows = next(tasks)
    for start in fold_starts(sum(rows for _, rows in task_rows), folds):
        while start >= before + rows:
            before += rows
            current, rows = next(tasks)
        cuts.append((current, start - before))
    return cuts


@dataclass(frozen=True)
class Folds:
    """Rows stored in order with their ``task`` and ``position``, and where the folds begin."""

    stored: DataFrame
    columns: list[str]
    cuts: list[tuple[int, int]]

    @staticmethod
    def _from(cut: tuple[int, int]) -> Column:
        task, position = cut
        return (F.col("task") > task) | ((F.col("task") == task) & (F.col("position") >= position))

    @staticmethod
    def _before(cut: tuple[int, int]) -> Column:
        task, position = cut
        return (F.col("task") < task) | ((F.col("task") == task) & (F.col("position") < position))

    def rows(self) -> DataFrame:
        """All rows with ``fold``."""
        fold = F.lit(0)
        for cut in self.cuts:
            fold = fold + self._from(cut).cast("int")
        return self.stored.select(*self.columns, fold.alias("fold"))

    def held_out(self, fold: int) -> DataFrame:
        """Rows of one fold. Ranges of stored columns let the scan skip the other folds' row groups."""
        found = self.stored
        if fold:
            found = found.filter(self._from(self.cuts[fold - 1]))
        if fold < len(self.cuts):
            found = found.filter(self._before(self.cuts[fold]))
        return found.select(*self.columns)

    def others(self, fold: int) -> DataFrame:
        """Rows of all other folds."""
        parts = [self._before(self.cuts[fold - 1])] if fold else []
        if fold < len(self.cuts):
            parts.append(self._from(self.cuts[fold]))
        return self.stored.filter(reduce(or_, parts)).select(*self.columns)


def assign_folds(df: DataFrame, order_by: Sequence[str], folds: int = 5) -> DataFrame:
    """Adds ``fold`` (0 to folds-1): contiguous, unshuffled cuts of the rows sorted by ``order_by``."""
    return cut_folds(materialize(in_order(df, order_by), "folds"), folds).rows()


def in_order(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``df`` sorted over its tasks, with each row's ``task`` and ``position`` in it.

    Spark rows have no file order, so the caller names one. Rows are range-partitioned and sorted
    by it in parallel. A hash of the other columns and the number of the copy among equal rows
    break ties, so that neither a date with a third of all rows nor a large group of equal rows has
    to fit one task, and a task that is run again sends every row to the same place.
    """
    rest = [c for c in df.columns if c not in order_by]
    order = [*order_by, *([F.xxhash64(*rest)] if rest else []), "copy"]
    in_task = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    return (
        repeat_copies(merge_copies(df))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*df.columns, F.spark_partition_id().alias("task"), in_task.alias("position"))
    )


def cut_folds(stored: DataFrame, folds: int) -> Folds:
    """Folds of stored rows in order. Only row counts per task reach the driver; each fold start
    becomes one (task, position) literal, so that a fold costs no join and no second sort."""
    counts = stored.groupBy("task").count().orderBy("task").collect()
    if not counts:
        raise ValueError(f"cannot cut 0 rows into {folds} folds")
    columns = [c for c in stored.columns if c not in ("task", "position")]
    return Folds(stored, columns, _cuts([(c["task"], c["count"]) for c in counts], folds))
