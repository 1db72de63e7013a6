import pytest
from pyspark.sql import functions as F, types as T

from sales_cases import column, day
from shelfcast.sources import readers
from shelfcast.sources.writers import write_predictions


def write(path, text):
    path.write_text(text)
    return str(path)


def test_train_csv_is_typed_and_matched_by_header(spark, tmp_path):
    path = write(tmp_path / "train.csv", "date,family,id,store_nbr,sales,onpromotion\n2017-08-16,\"BREAD, BAKERY\",7,54,1.5,3\n")
    df = readers.read_train(spark, path)
    assert [f.dataType for f in df.schema] == [
        T.LongType(), T.DateType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.LongType()
    ]
    assert tuple(df.first()) == (7, day("2017-08-16"), 54, "BREAD, BAKERY", 1.5, 3)


def test_test_csv_has_no_sales(spark, tmp_path):
    path = write(tmp_path / "test.csv", "id,date,store_nbr,family,onpromotion\n1,2017-08-16,1,A,0\n")
    assert readers.read_test(spark, path).columns == ["id", "date", "store_nbr", "family", "onpromotion"]


def test_missing_cells_and_null_tokens(spark, tmp_path):
    path = write(tmp_path / "oil.csv", "date,dcoilwtico\n2013-01-01,\n2013-01-02,NaN\n2013-01-03,n/a\n2013-01-04,93.14\n")
    assert column(readers.read_oil(spark, path), "dcoilwtico", "date") == [None, None, None, 93.14]


def test_integers_saved_with_a_decimal_point(spark, tmp_path):
    path = write(tmp_path / "transactions.csv", "date,store_nbr,transactions\n2013-01-01,1,770.0\n2013-01-02,1,\n")
    assert column(readers.read_transactions(spark, path), "transactions", "date") == [770, None]


def test_quoted_quotes_and_optional_columns(spark, tmp_path):
    path = write(tmp_path / "holidays.csv", 'date,type,description\n2012-03-02,Holiday,"the ""Big"" day"\n')
    row = readers.read_holidays(spark, path).first()
    assert (row["description"], row["locale"], row["transferred"]) == ('the "Big" day', None, None)


def test_required_column_missing(spark, tmp_path):
    path = write(tmp_path / "oil.csv", "date\n2013-01-01\n")
    with pytest.raises(ValueError, match="dcoilwtico"):
        readers.read_oil(spark, path)


def test_malformed_date_raises(spark, tmp_path):
    path = write(tmp_path / "oil.csv", "date,dcoilwtico\nyesterday,1\n")
    with pytest.raises(Exception, match="yesterday"):
        readers.read_oil(spark, path).collect()


def test_parquet_with_other_types(spark, tmp_path):
    path = str(tmp_path / "oil.parquet")
    spark.sql("SELECT timestamp'2013-01-02 00:00:00' AS date, CAST(93 AS INT) AS dcoilwtico").write.parquet(path)
    assert tuple(readers.read_oil(spark, path).first()) == (day("2013-01-02"), 93.0)


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unknown format"):
        readers.read_oil(spark, "oil.xls", fmt="excel")


def test_predictions_are_overwritten_and_every_part_has_a_header(spark, tmp_path):
    path = str(tmp_path / "predictions")
    write_predictions(spark.range(3).withColumn("sales", F.lit(1.0)), path)
    ids = spark.range(0, 100, 1, numPartitions=4).withColumn("sales", F.col("id") / 8).withColumn("more", F.lit(1))
    write_predictions(ids, path)
    back = spark.read.schema("id long, sales double").option("header", True).csv(path)
    assert sorted(map(tuple, back.collect())) == [(i, i / 8) for i in range(100)]
    parts = list((tmp_path / "predictions").glob("part-*.csv"))
    assert len(parts) == 4 and all(p.read_text().startswith("id,sales\n") for p in parts)


def test_files_with_other_column_orders_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", "date,store_nbr,transactions\n2017-01-01,1,10\n")
    write(tmp_path / "b.csv", "date,transactions,store_nbr\n2017-01-02,20,2\n")
    with pytest.raises(Exception, match="different orders"):
        readers.read_transactions(spark, str(tmp_path)).collect()


def test_files_with_the_same_header_are_read_together(spark, tmp_path):
    write(tmp_path / "a.csv", "date,store_nbr,transactions\n2017-01-01,1,10\n")
    write(tmp_path / "b.csv", "date,store_nbr,transactions\n2017-01-02,2\n")
    rows = readers.read_transactions(spark, str(tmp_path)).orderBy("date").collect()
    assert [tuple(row)[1:] for row in rows] == [(1, 10), (2, None)]


def test_surplus_cells_are_refused(spark, tmp_path):
    path = write(tmp_path / "oil.csv", "date,dcoilwtico\n2017-01-03,1,234.5\n")
    with pytest.raises(Exception, match="more cells"):
        readers.read_oil(spark, path).collect()


def test_quoted_line_breaks_are_refused(spark, tmp_path):
    path = write(tmp_path / "holidays.csv", 'date,type,description\n2012-03-02,Holiday,"two\nlines"\n')
    with pytest.raises(Exception):
        readers.read_holidays(spark, path).collect()
