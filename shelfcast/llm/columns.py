"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.session import shared_dir, ship_package

BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Readies a session for Python work on texts; called by every operator that needs it.

    The package's source goes to the workers, once per application, as executors have no copy of it
    unless the job was submitted with one. Batches are bounded by bytes as well as rows, so that a
    worker's memory does not follow the length of texts.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship_package(spark)


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, for small tables that are read again."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (names ignore case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def tokenizer_file(name: str) -> str:
    """Path of a tokenizer file of the ``public_tokenizers`` package."""
    import public_tokenizers

    return public_tokenizers.path(name)
