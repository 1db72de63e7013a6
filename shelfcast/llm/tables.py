"""Intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from shelfcast.session import delete, new_shared_path

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _freeing_shuffles(spark: SparkSession):
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = new_shared_path(spark, label)
    with _freeing_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read from there; its shuffle files are freed at once."""
    return _written(df, label)[0]


Put = Callable[[DataFrame, str], DataFrame]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Put]:
    """``stored`` for the length of a block, at whose end the files are deleted.

    What leaves the block must be stored elsewhere. Shuffle files of every action in the block are freed
    when it is done.
    """
    paths = []

    def put(df: DataFrame, label: str) -> DataFrame:
        table, path = _written(df, label)
        paths.append(path)
        return table

    try:
        with _freeing_shuffles(spark):
            yield put
    finally:
        for path in paths:
            delete(spark, path)
