"""Every query with an SQL counterpart gives the same rows in DuckDB."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, connect
from shelfcast.catalogue.oracle import ORACLE
from shelfcast.catalogue.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    table = QUERIES[name](spark, SF_DIR).toArrow()
    assert table.num_rows > 0
    assert compare(table, duck.sql(ORACLE[name]).to_arrow_table()) == []


def test_contract_lists_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["date", "transactions", "7_day_MA", "14_day_MA", "30_day_MA", "60_day_MA"]


def test_queries_without_sql_are_the_randomised_models():
    assert set(QUERIES) - set(ORACLE) == {
        "predict_decision", "predict_forest", "predict_gbt", "grid_scores_tree"
    }
