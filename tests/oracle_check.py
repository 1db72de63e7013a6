"""Compares every query with its SQL counterpart: row count, column names and types, values.

    python tests/oracle_check.py [folder of tables] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

ROOT = Path(__file__).resolve().parents[1]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    rows = zip(*[table.column(name).to_pylist() for name in names])
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def compare(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    """Differences, empty if the tables are equal as multisets of rows."""
    if sorted(spark_table.column_names) != sorted(sql_table.column_names):
        return [f"columns {spark_table.column_names} != {sql_table.column_names}"]
    problems = []
    for name in spark_table.column_names:
        left, right = spark_table.schema.field(name).type, sql_table.schema.field(name).type
        if left != right and not (pa.types.is_string(left) and pa.types.is_string(right)):
            problems.append(f"{name}: {left} != {right}")
    if spark_table.num_rows != sql_table.num_rows:
        problems.append(f"rows {spark_table.num_rows} != {sql_table.num_rows}")
        return problems
    different = [
        (a, b) for a, b in zip(_rows(spark_table), _rows(sql_table))
        if any(x != y and not (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
               for x, y in zip(a, b))
    ]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}")
    return problems


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as contract
    from shelfcast.session import build_session

    spark = build_session("oracle-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, failed = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        table = query(spark, sf_dir).toArrow()
        seconds = time.time() - begin
        if name in oracle:
            problems = compare(table, con.sql(oracle[name]).to_arrow_table())
        else:
            problems = [] if table.num_rows else ["no rows"]
        failed += bool(problems)
        kind = "sql " if name in oracle else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name:28s} {table.num_rows:7d} rows {seconds:6.2f}s", *problems, flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
