"""Runs a registered query on Spark and its SQL on DuckDB and compares columns, types and rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

SALES_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def open_duckdb(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in SALES_TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _shape(table: pa.Table) -> list[tuple[str, str]]:
    return sorted((field.name, str(field.type).replace("large_", "")) for field in table.schema)


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    return Counter(zip(*[table.column(name).to_pylist() for name in names]))


def differences(spark_table: pa.Table, sql_table: pa.Table) -> list[str]:
    found = []
    if _shape(spark_table) != _shape(sql_table):
        found.append(f"columns {_shape(spark_table)} != {_shape(sql_table)}")
    if spark_table.num_rows != sql_table.num_rows:
        found.append(f"rows {spark_table.num_rows} != {sql_table.num_rows}")
    left, right = _rows(spark_table), _rows(sql_table)
    if left != right:
        found.append(f"only spark {list((left - right).items())[:3]} "
                     f"only sql {list((right - left).items())[:3]}")
    return found


def run_sql(connection: duckdb.DuckDBPyConnection, sql: str) -> pa.Table:
    return connection.sql(sql).to_arrow_table()
