from collections import Counter

import pytest
from pyspark.sql import functions as F

from sales_cases import column, day
from shelfcast.operators import joins
from shelfcast.operators.joins import enrich, join_holidays, join_oil, left_join_on_date
from shelfcast.sources import readers

# Room for everything, for distinct rows only, for nothing.
LIMITS = [joins.BROADCAST_BYTES, 400, 0]


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(1, "2017-01-06", 0), (2, "2017-01-07", 2), (3, "2017-01-08", None)]
    return spark.createDataFrame([(i, day(d), n) for i, d, n in rows], "id long, date date, onpromotion long")


@pytest.fixture(scope="module")
def holidays(spark):
    rows = [("2017-01-07", "Event"), ("2017-01-08", "Holiday"), ("2017-01-08", "Event"), ("2017-02-01", "Holiday")]
    return spark.createDataFrame([(day(d), t) for d, t in rows], "date date, type string")


@pytest.fixture(scope="module")
def oil(spark):
    return spark.createDataFrame([(day("2017-01-06"), 50.5), (day("2017-01-08"), None)], "date date, dcoilwtico double")


@pytest.mark.parametrize("limit", LIMITS)
def test_holiday_fan_out(spark, sales, holidays, limit):
    joined = join_holidays(sales, holidays, broadcast_bytes=limit)
    assert sorted(map(tuple, joined.select("id", F.coalesce("type", F.lit("-"))).collect())) == [
        (1, "-"), (2, "Event"), (3, "Event"), (3, "Holiday")
    ]


@pytest.mark.parametrize("limit", LIMITS)
def test_dedupe_keeps_one_row_per_sale(spark, sales, holidays, limit):
    joined = join_holidays(sales, holidays, dedupe=True, broadcast_bytes=limit)
    assert column(joined, "type", "id") == [None, "Event", "Event"]


def test_oil_gaps(spark, sales, oil):
    assert column(join_oil(sales, oil), "dcoilwtico", "id") == [50.5, None, None]


def test_enrich_flags(spark, sales, oil, holidays):
    rows = enrich(sales, oil, holidays).orderBy("id", "type").collect()
    assert [(r["id"], r["onpromotion"], r["is_holiday"]) for r in rows] == [(1, 0, 0), (2, 1, 1), (3, 0, 1), (3, 0, 1)]


def test_untyped_holiday_row_repeats_but_is_no_holiday(spark, sales, oil):
    untyped = spark.createDataFrame([(day("2017-01-06"), None)] * 2, "date date, type string")
    rows = enrich(sales, oil, untyped).filter("id = 1").collect()
    assert [r["is_holiday"] for r in rows] == [0, 0]


def test_undated_rows_are_refused(spark, sales):
    with pytest.raises(ValueError, match="without a date"):
        join_holidays(sales, spark.createDataFrame([(None, "Event")], "date date, type string"))


def test_empty_side(spark, sales, holidays):
    assert column(join_holidays(sales, holidays.filter("false")), "type", "id") == [None] * 3


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 2000, 0])
def test_many_copies_and_a_hot_date(spark, limit):
    """A third of the sales share one date, which has 5000 equal rows and 3 others on the other side."""
    hot, cold = F.lit("2017-01-01").cast("date"), F.date_add(F.lit("2017-01-02").cast("date"), (F.col("id") % 40).cast("int"))
    sales = spark.range(90).withColumn("date", F.when(F.col("id") % 3 == 0, hot).otherwise(cold))
    other = spark.range(5000).select(hot.alias("date"), F.lit("a").alias("type")).union(
        spark.range(3).select(hot.alias("date"), F.lit("b"))
    ).union(spark.range(30).select(cold.alias("date"), F.lit("c")))
    joined = left_join_on_date(sales, other, ["type"], limit)
    got = Counter({(r["date"], r["type"]): r["count"] for r in joined.groupBy("date", "type").count().collect()})
    per_date = Counter(r["date"] for r in sales.collect())
    rows = Counter((r["date"], r["type"]) for r in other.collect())
    expected = Counter({key: n * per_date[key[0]] for key, n in rows.items() if per_date[key[0]]})
    expected.update({(d, None): n for d, n in per_date.items() if not any(d == key[0] for key in rows)})
    assert got == expected


def test_shuffle_join_spreads_a_hot_date(spark):
    sales = spark.range(0, 60_000, 1, 8).withColumn(
        "date", F.when(F.col("id") % 3 == 0, F.lit("2017-01-01").cast("date"))
        .otherwise(F.date_add(F.lit("2017-01-02").cast("date"), (F.col("id") % 300).cast("int")))
    )
    other = spark.range(300).select(F.date_add(F.lit("2017-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit("t").alias("type"))
    joined = left_join_on_date(sales, other, ["type"], 0)
    assert joined.count() == 60_000 and joined.columns == ["date", "id", "type"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = joined.filter("date = '2017-01-01'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) >= 4


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_rewritten_file_is_seen(spark, sales, tmp_path, fmt, limit):
    path = f"{tmp_path}/oil.{fmt}"
    for price in (50.0, 99.0):
        table = spark.createDataFrame([(day("2017-01-06"), price)], "date date, dcoilwtico double")
        table.write.mode("overwrite").format(fmt).option("header", True).save(path)
        assert column(join_oil(sales, readers.read_oil(spark, path), limit), "dcoilwtico", "id") == [price, None, None]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_shuffle_join_uses_more_tasks_than_dates(spark):
    sales = spark.range(0, 9000, 1, 8).withColumn("date", F.date_add(F.lit("2017-01-01").cast("date"), (F.col("id") % 3).cast("int")))
    other = spark.range(3).select(F.date_add(F.lit("2017-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit("t").alias("type"))
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = left_join_on_date(sales, other, ["type"], 0)
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(row["count"] for row in tasks) == 9000
    assert len(tasks) > 12 and max(row["count"] for row in tasks) < 1500
