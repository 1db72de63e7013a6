"""Declared schemas of the five inputs."""

from __future__ import annotations

from pyspark.sql import types as T

TRAIN = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("family", T.StringType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("onpromotion", T.LongType()),
])

TEST = T.StructType([field for field in TRAIN if field.name != "sales"])

OIL = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("dcoilwtico", T.DoubleType()),
])

HOLIDAYS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("type", T.StringType()),
    T.StructField("locale", T.StringType()),
    T.StructField("locale_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("transferred", T.BooleanType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("transactions", T.LongType()),
])

# Columns a file may leave out; they are then read as NULL.
OPTIONAL = {"train": {"id"}, "test": set(), "oil": set(), "transactions": set(),
            "holidays": {"locale", "locale_name", "description", "transferred"}}
