import pytest
from pyspark.sql import functions as F

from sales_cases import column, day
from shelfcast.operators.ordering import assign_folds, cut_folds, fold_starts, in_order, sort_by_date
from shelfcast.session import materialize, materialized, new_shared_path


def test_fold_sizes():
    assert fold_starts(13, 5) == [3, 6, 9, 11]
    assert fold_starts(10, 5) == [2, 4, 6, 8]


@pytest.mark.parametrize("rows, folds", [(4, 5), (0, 5), (10, 1)])
def test_impossible_folds(rows, folds):
    with pytest.raises(ValueError):
        fold_starts(rows, folds)


def test_folds_are_contiguous(spark):
    df = spark.range(13).select(((F.col("id") * 5) % 13).alias("n")).repartition(4)
    assert column(assign_folds(df, ["n"]), "fold", "n") == [0] * 3 + [1] * 3 + [2] * 3 + [3] * 2 + [4] * 2


def test_too_few_rows(spark):
    with pytest.raises(ValueError, match="cannot cut"):
        assign_folds(spark.range(3), ["id"])
    with pytest.raises(ValueError, match="cannot cut"):
        assign_folds(spark.range(0), ["id"])


def test_matches_ntile_with_a_hot_date_and_equal_rows(spark):
    hot = F.lit("2017-03-01").cast("date")
    cold = F.date_add(F.lit("2017-01-01").cast("date"), (F.col("id") % 200).cast("int"))
    df = spark.range(0, 9001, 1, 8).select(
        F.when(F.col("id") % 3 == 0, hot).otherwise(cold).alias("date"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 7)).cast("int").alias("store_nbr"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folded = assign_folds(df, ["date", "store_nbr"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = folded.groupBy("date", "store_nbr", "fold").count()
    df.createOrReplaceTempView("rows_to_cut")
    want = spark.sql(
        """SELECT date, store_nbr, fold, count(*) AS count FROM
           (SELECT *, ntile(5) OVER (ORDER BY date, store_nbr) - 1 AS fold FROM rows_to_cut) GROUP BY ALL"""
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # The 3001 equal rows did not share one task.
    hot_files = folded.filter("date = '2017-03-01' AND store_nbr = 1").select(F.input_file_name()).distinct().count()
    assert hot_files > 1


def test_sort_by_date(spark):
    rows = [("2017-01-02", 1), ("2017-01-01", 2), ("2017-01-01", 1)]
    df = spark.createDataFrame([(day(d), s) for d, s in rows], "date date, store_nbr int")
    assert [tuple(r) for r in sort_by_date(df, "store_nbr").collect()] == sorted((day(d), s) for d, s in rows)


def test_fold_parts_are_ranges_that_reach_the_scan(spark):
    df = spark.range(40).select(((F.col("id") * 7) % 40).alias("n")).repartition(4)
    folds = cut_folds(materialize(in_order(df, ["n"]), "folds"), 5)
    by_fold = {row["fold"]: row["ns"] for row in folds.rows().groupBy("fold").agg(F.sort_array(F.collect_list("n")).alias("ns")).collect()}
    for fold in range(5):
        assert column(folds.held_out(fold), "n", "n") == by_fold[fold]
        assert column(folds.others(fold), "n", "n") == sorted(n for other, ns in by_fold.items() if other != fold for n in ns)
        for part in (folds.held_out(fold), folds.others(fold)):
            plan = part._jdf.queryExecution().executedPlan().toString()
            assert "task" in plan.split("PushedFilters: ")[1].split("]")[0]


def test_stored_rows_are_deleted_after_their_block(spark, tmp_path):
    import os

    with materialized(spark.range(3), "short-lived") as rows:
        assert rows.count() == 3
        folder = os.path.dirname(rows.inputFiles()[0].removeprefix("file://"))
        assert os.path.exists(folder)
    assert not os.path.exists(folder)
    assert new_shared_path(spark, "x") != new_shared_path(spark, "x")
