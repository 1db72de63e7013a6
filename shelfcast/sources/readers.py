"""Readers for the five inputs, from CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfcast.sources import schemas

# Cell texts that count as missing in a CSV file.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


SURPLUS = "cells beyond the header"


def _csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, by the header of the first file, without any header rows.

    A row with more cells than the header is an error, and so is a file whose header has the same
    names in another order; with other names its header fails the casts. Missing cells at the end of
    a row are NULL.
    """
    names = spark.read.options(header=True, escape='"').csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, SURPLUS]])
    rows = spark.read.schema(schema).options(header=False, escape='"').csv(path)
    cells = [F.col(f"`{name}`") for name in names]
    same = F.lit(True)
    for name, cell in zip(names, cells):
        same = same & cell.eqNullSafe(F.lit(name))
    # Only a row that starts with a column's name can be a header; others need no sorting.
    moved = cells[0].isin(names) & (
        F.array_sort(F.array(*[F.coalesce(cell, F.lit("")) for cell in cells])) == F.array_sort(F.array(*map(F.lit, names)))
    )
    surplus = F.col(f"`{SURPLUS}`").isNotNull()
    fault = F.when(surplus, F.lit("a row has more cells than the header")).when(
        ~same & moved, F.lit("files have the same columns in different orders")
    )
    sound = F.when(fault.isNotNull(), F.raise_error(F.concat(F.lit(f"{path}: "), fault)).cast("boolean")).otherwise(~same)
    return rows.filter(sound).select(*[cell.alias(name) for name, cell in zip(names, cells)])


def _typed_cell(field: T.StructField) -> Column:
    """Cell text as the declared type. ANSI casts raise on text that does not parse."""
    cell = F.col(f"`{field.name}`")
    present = F.when(~F.coalesce(cell, F.lit("")).isin(NULL_TOKENS), cell)
    if isinstance(field.dataType, T.StringType):
        return present.alias(field.name)
    text = F.trim(present)
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        # A column with gaps is often saved with a decimal point ("3.0").
        text = F.regexp_replace(text, r"\.0+$", "")
    return text.cast(field.dataType).alias(field.name)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    optional: set[str] = frozenset(),
    fmt: str | None = None,
) -> DataFrame:
    """Read one input with a declared schema; columns are matched by header name.

    A CSV folder's files must have one header; rows with more cells than it are an error.

    ``fmt`` is ``csv`` or ``parquet``, taken from the path's ending if not given (CSV by default).
    Quoted line breaks are not supported, so that large files stay splittable.
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    elif fmt == "csv":
        raw = _csv_rows(spark, path)
    else:
        raise ValueError(f"unknown format {fmt!r}: use 'csv' or 'parquet'")

    missing = [f.name for f in schema if f.name not in raw.columns and f.name not in optional]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")

    def column(field: T.StructField) -> Column:
        if field.name not in raw.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if fmt == "csv":
            return _typed_cell(field)
        if raw.schema[field.name].dataType == field.dataType:
            return F.col(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return raw.select(*[column(field) for field in schema])


def read_train(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return read_table(spark, path, schemas.TRAIN, schemas.OPTIONAL["train"], fmt)


def read_test(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return read_table(spark, path, schemas.TEST, schemas.OPTIONAL["test"], fmt)


def read_oil(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return read_table(spark, path, schemas.OIL, schemas.OPTIONAL["oil"], fmt)


def read_holidays(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return read_table(spark, path, schemas.HOLIDAYS, schemas.OPTIONAL["holidays"], fmt)


def read_transactions(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return read_table(spark, path, schemas.TRANSACTIONS, schemas.OPTIONAL["transactions"], fmt)
