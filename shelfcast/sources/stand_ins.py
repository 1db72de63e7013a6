"""The five inputs derived from order tables, for checks where no store data is at hand.

Each function takes the folder of ``<table>.parquet`` files and, where useful, inclusive date
bounds. The bounds compare the raw order timestamp, so they reach the scan of ``orders``. Joins
carry no hints: sizes are unknown here, and the adaptive planner broadcasts or splits as measured.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Bounds = tuple[date, date] | None

EPOCH = date(1995, 1, 1)
TEST_START = date(2001, 1, 1)
FAMILIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str, bounds: Bounds) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    if bounds:
        start, end = bounds
        moment = F.col("o_orderdate")
        as_type = orders.schema["o_orderdate"].dataType
        orders = orders.filter(
            (moment >= F.lit(start.isoformat()).cast(as_type))
            & (moment < F.lit((end + timedelta(days=1)).isoformat()).cast(as_type))
        )
    return orders.withColumn("date", F.col("o_orderdate").cast("date"))


def _orders_by_store(spark: SparkSession, sf_dir: str, bounds: Bounds) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") + 1).alias("store_nbr")
    )
    return _orders(spark, sf_dir, bounds).join(customers, "o_custkey")


def transactions(spark: SparkSession, sf_dir: str, bounds: Bounds = None) -> DataFrame:
    return (
        _orders_by_store(spark, sf_dir, bounds)
        .groupBy("date", "store_nbr")
        .agg(F.count(F.lit(1)).alias("transactions"))
    )


def _sales_id() -> Column:
    family_no = F.lit(len(FAMILIES) - 1)
    for position, family in enumerate(FAMILIES[:-1]):
        family_no = F.when(F.col("family") == family, position).otherwise(family_no)
    return F.datediff("date", F.lit(EPOCH)).cast("long") * 150 + (F.col("store_nbr") - 1) * 6 + family_no


def sales(spark: SparkSession, sf_dir: str, bounds: Bounds = None) -> DataFrame:
    """Sales per date, store and family; returned items count negative."""
    orders = _orders_by_store(spark, sf_dir, bounds).select(
        F.col("o_orderkey").alias("l_orderkey"), "date", "store_nbr"
    )
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("family"))
    price = F.col("l_extendedprice")
    return (
        _table(spark, sf_dir, "lineitem")
        .join(orders, "l_orderkey")
        .join(parts, "l_partkey")
        .groupBy("date", "store_nbr", "family")
        .agg(
            F.sum(F.when(F.col("l_returnflag") == "R", -price).otherwise(price)).alias("sales"),
            F.count_if(F.col("l_discount") >= 0.09).alias("onpromotion"),
        )
        .select(_sales_id().alias("id"), "date", "store_nbr", "family", "sales", "onpromotion")
    )


def train(spark: SparkSession, sf_dir: str, bounds: Bounds = None) -> DataFrame:
    start, end = bounds or (date(1, 1, 1), date(9999, 1, 1))
    return sales(spark, sf_dir, (start, min(end, TEST_START - timedelta(days=1))))


TEST_BOUNDS = (TEST_START, date(9999, 1, 1))


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir, TEST_BOUNDS).drop("sales")


def oil(spark: SparkSession, sf_dir: str, bounds: Bounds = None) -> DataFrame:
    """Weekdays only, and present without a price on the first of a month.

    The mean order total in thousands, from an exact sum of cents, so that every engine and every
    partitioning gives the same double.
    """
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))
    daily = (
        _orders(spark, sf_dir, bounds)
        .filter(F.dayofweek("date").between(2, 6))
        .groupBy("date")
        .agg((cents.cast("double") / (F.count(F.lit(1)) * 100_000).cast("double")).alias("price"))
    )
    return daily.select("date", F.when(F.dayofmonth("date") != 1, F.col("price")).alias("dcoilwtico"))


def holidays(spark: SparkSession, sf_dir: str, bounds: Bounds = None) -> DataFrame:
    """Some dates have several rows."""
    return (
        _orders(spark, sf_dir, bounds)
        .filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 10 == 0))
        .select("date", F.col("o_orderstatus").alias("type"))
    )
