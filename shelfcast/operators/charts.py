"""Tables behind the charts, reduced on the cluster before a plotting tool sees them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from shelfcast.operators.aggregates import value_counts
from shelfcast.operators.filters import CATEGORICAL, NUMERIC, fill_zero
from shelfcast.operators.ordering import in_order
from shelfcast.session import materialize, materialized

# Column names the charts offer.
TRANSACTION_AXES = ["date", "store_nbr", "transactions", "datetime"]
DAILY_AXES = ["date", "transactions", "7_day_MA", "14_day_MA", "30_day_MA", "60_day_MA"]
FEATURE_AXES = [*CATEGORICAL, *NUMERIC]


def _require(df: DataFrame, column: str, numeric: bool = False) -> None:
    if column not in df.columns:
        raise ValueError(f"no column {column!r}: choose one of {df.columns}")
    if numeric and not isinstance(df.schema[column].dataType, T.NumericType):
        raise ValueError(f"column {column!r} is not numeric")


def scatter_data(df: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """Points ``x, y, z`` of a 3-D scatter; ``z`` also drives colour and size. Missing numbers are 0."""
    for axis in (x, y, z):
        _require(df, axis)
    filled = fill_zero(df, list(dict.fromkeys([x, y, z])))
    return filled.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(z).alias("z"))


def scatter_counts(points: DataFrame) -> DataFrame:
    """Points of a scatter, equal ones merged: ``x, y, z, count``. There are as many as distinct points."""
    return points.groupBy("x", "y", "z").agg(F.count(F.lit(1)).alias("count"))


def scatter_grid(points: DataFrame, cells: int = 50) -> DataFrame:
    """Points of a scatter counted in a grid: ``x, y, z, count`` of the cells that hold any.

    Every number or date axis is cut into ``cells`` parts of equal width between its extremes and is given
    by the lower edge of the part, a date's rounded down to a day; the last part includes the upper
    extreme. A text axis keeps its values, and missing dates and texts stay NULL.
    """
    if cells < 1:
        raise ValueError("cells must be at least 1")
    merged, kinds = scatter_counts(points), {field.name: field.dataType for field in points.schema}
    axes = [axis for axis in "xyz" if not isinstance(kinds[axis], T.StringType)]

    def number(axis: str) -> Column:
        return F.unix_date(axis).cast("double") if isinstance(kinds[axis], T.DateType) else F.col(axis).cast("double")

    edges = {}
    for axis in axes:
        span = merged.agg(F.struct(F.min(number(axis)).alias("low"), F.max(number(axis)).alias("high"))).scalar()
        low, high = span.getField("low"), span.getField("high")
        part = F.coalesce(F.least(F.width_bucket(number(axis), low, high, F.lit(cells)), F.lit(cells)), F.lit(1)) - 1
        edge = F.when(number(axis).isNotNull(), low + part * ((high - low) / cells))
        edges[axis] = F.date_from_unix_date(F.floor(edge).cast("int")) if isinstance(kinds[axis], T.DateType) else edge
    cut = merged.select(*[edges.get(axis, F.col(axis)).alias(axis) for axis in "xyz"], "count")
    return cut.groupBy("x", "y", "z").agg(F.sum("count").alias("count"))


def scatter_transactions(transactions: DataFrame, x: str, y: str, z: str) -> DataFrame:
    return scatter_data(transactions.withColumn("datetime", F.col("date")).select(*TRANSACTION_AXES), x, y, z)


def scatter_daily(daily: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """Warm-up rows without an average are drawn at 0."""
    return scatter_data(daily.select(*DAILY_AXES), x, y, z)


def scatter_features(features: DataFrame, x: str, y: str, z: str) -> DataFrame:
    if z in CATEGORICAL:
        raise ValueError(f"z cannot be {z!r}: it sets the marker size")
    return scatter_data(features.select(*FEATURE_AXES), x, y, z)


def bar_data(df: DataFrame, x: str, y: str) -> DataFrame:
    """Bar height per ``x``: the sum of ``y``, as rows with equal ``x`` stack."""
    _require(df, x)
    _require(df, y, numeric=True)
    pairs = df.select(F.col(x).alias("x"), F.col(y).alias("y"))
    return fill_zero(pairs, ["x", "y"]).groupBy("x").agg(F.sum("y").alias("y"))


def line_data(df: DataFrame, x: str, y: str, *order_by: str) -> DataFrame:
    """Every point of the line, in row order."""
    _require(df, x)
    _require(df, y)
    ordered = fill_zero(df, list(dict.fromkeys([x, y]))).orderBy(*order_by)
    return ordered.select(F.col(x).alias("x"), F.col(y).alias("y"))


def line_columns(df: DataFrame, x: str, y: str, *order_by: str, columns: int = 1000) -> DataFrame:
    """The line in row order for a plot that is ``columns`` wide: ``column, place, x, y``, by ``place``.

    Rows in order are cut into ``columns`` stretches that differ by one row at most. Of each the first,
    the last, the lowest and the highest point stay (the earliest of equal ones), so it is drawn as the
    whole line would be. ``place`` is the row's number in the order, from 0. Rows are sorted over all
    tasks and stored; only row counts per task reach the driver.
    """
    _require(df, x)
    _require(df, y)
    if columns < 1:
        raise ValueError("columns must be at least 1")
    filled = fill_zero(df, list(dict.fromkeys([x, y])))
    stored = materialize(in_order(filled, order_by), "line")
    tasks = stored.groupBy("task").count().orderBy("task").collect()
    before = accumulate([row["count"] for row in tasks], initial=0)
    begins = F.create_map(*[F.lit(part) for row, begin in zip(tasks, before) for part in (row["task"], begin)]) if tasks else F.create_map()
    rows = max(1, sum(row["count"] for row in tasks))
    place = (F.try_element_at(begins, F.col("task")) + F.col("position")) if tasks else F.lit(0).cast("long")
    points = stored.select(place.alias("place"), F.col(x).alias("x"), F.col(y).alias("y"))
    column = F.floor(F.col("place") * columns / rows).cast("int").alias("column")
    point = F.struct("place", "x", "y")
    kept = points.groupBy(column).agg(
        F.array_distinct(F.array(
            F.min(point), F.max(point), F.min_by(point, F.struct("y", "place")), F.max_by(point, F.struct(F.col("y"), -F.col("place")))
        )).alias("points")
    )
    return kept.select("column", F.explode("points").alias("point")).select("column", "point.*").orderBy("place")


def line_summary(df: DataFrame, x: str, y: str) -> DataFrame:
    """The same line for plotting at scale: range and mean of ``y`` per ``x``."""
    _require(df, x)
    _require(df, y, numeric=True)
    pairs = df.select(F.col(x).alias("x"), F.col(y).alias("y"))
    return (
        fill_zero(pairs, ["x", "y"])
        .groupBy("x")
        .agg(F.min("y").alias("y_min"), F.avg("y").alias("y_mean"), F.max("y").alias("y_max"))
    )


def pie_data(df: DataFrame, column: str) -> DataFrame:
    """``category, count``; missing values have no slice."""
    _require(df, column)
    return value_counts(df, column)


def histogram_data(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Text: ``value, count``, missing texts as NULL like in ``bar_data``. Numbers: ``bin, low, high, count`` for equal-width bins, empty ones included.

    The last bin includes its upper edge. If all values are equal they are in bin 1.
    """
    _require(df, column)
    if not isinstance(df.schema[column].dataType, T.NumericType):
        return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if bins < 1:
        raise ValueError("bins must be at least 1")
    values = _counts_per_value(df, column)
    span = values.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high"))).scalar()
    low, high = span.getField("low"), span.getField("high")
    bucket = F.width_bucket("value", low, high, F.lit(bins))
    counts = (
        values.groupBy(F.least(F.coalesce(bucket, F.lit(1)), F.lit(bins)).cast("int").alias("bin"))
        .agg(F.sum("rows").alias("count"))
    )
    width = (high - low) / bins
    edges = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (low + (F.col("bin") - 1) * width).alias("low"),
        (low + F.col("bin") * width).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _counts_per_value(df: DataFrame, column: str) -> DataFrame:
    """``value, rows``: equal numbers merged, missing ones as 0."""
    values = fill_zero(df.select(F.col(column).cast("double").alias("value")), ["value"])
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("rows"))


def _values_at(counts: DataFrame, shares: Sequence[float]) -> list[float | None]:
    """Values at shares of the sorted rows, interpolated linearly between neighbouring rows.

    Values are sorted over all tasks; row counts per task tell in which ones the wanted rows are,
    and only those rows are collected.
    """
    ordered = counts.repartitionByRange("value").select("value", "rows", F.spark_partition_id().alias("task"))
    with materialized(ordered, "box-values") as stored:
        totals = stored.groupBy("task").agg(F.sum("rows").alias("rows")).orderBy("task").collect()
        total = sum(row["rows"] for row in totals)
        if not total:
            return [None for _ in shares]
        wanted = [share * (total - 1) for share in shares]
        places = sorted({place for at in wanted for place in (int(at), min(int(at) + 1, total - 1))})
        begins = dict(zip([row["task"] for row in totals], accumulate([row["rows"] for row in totals], initial=0)))
        hits = {task: [place for place in places if begin <= place < begin + row["rows"]]
                for row in totals for task, begin in [(row["task"], begins[row["task"]])]}
        before = F.sum("rows").over(W.partitionBy("task").orderBy("value")) - F.col("rows")
        running = stored.filter(F.col("task").isin([task for task, own in hits.items() if own])).withColumn("before", before)
        inside = F.lit(False)
        for task, own in hits.items():
            for place in own:
                offset = place - begins[task]
                inside = inside | ((F.col("task") == task) & (F.col("before") <= offset) & (offset < F.col("before") + F.col("rows")))
        found = running.filter(inside).select("task", "before", "rows", "value").collect()
    at_place = {
        place: row["value"] for row in found for place in places
        if row["before"] <= place - begins[row["task"]] < row["before"] + row["rows"]
    }
    return [
        at_place[int(at)] + (at - int(at)) * (at_place[min(int(at) + 1, total - 1)] - at_place[int(at)]) for at in wanted
    ]


def box_data(df: DataFrame, column: str) -> DataFrame:
    """One row: ``whisker_low, q1, median, q3, whisker_high, outliers``.

    Quartiles are exact, interpolated linearly. Whiskers end at the last value within 1.5 times the
    interquartile range. Rows are first merged into counts per distinct value, so a value held by a
    third of the rows costs as much as any other, and no task holds all values.
    """
    _require(df, column, numeric=True)
    counts = _counts_per_value(df, column)
    q1, median, q3 = (F.lit(value).cast("double") for value in _values_at(counts, [0.25, 0.5, 0.75]))
    reach = (q3 - q1) * 1.5
    inside = F.col("value").between(q1 - reach, q3 + reach)
    return counts.agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("rows"))), F.lit(0)).alias("outliers"),
    ).select("whisker_low", q1.alias("q1"), median.alias("median"), q3.alias("q3"), "whisker_high", "outliers")
