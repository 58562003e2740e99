"""The registered queries against their SQL on DuckDB, and what the queries without SQL promise."""

from pathlib import Path

import duckdb
import pytest

import comparing
from tableflow.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    found = QUERIES[name](spark, FOLDER).toArrow()
    assert comparing.differences(found, comparing.run_sql(database, SQL[name])) == []
    assert found.num_rows > 0


@pytest.mark.parametrize("name, key", [("op1_sharding", "doc_id"), ("op2_lm_scoring", "doc_id"),
                                       ("op4_line_dedup", "doc_id"), ("op5_quality_classifier", "doc_id"),
                                       ("op8_license_scan", "doc_id")])
def test_one_row_for_each_document(spark, name, key):
    ids = [row[key] for row in spark.read.parquet(f"{FOLDER}/documents.parquet").select(key).collect()]
    assert sorted(row[key] for row in QUERIES[name](spark, FOLDER).select(key).collect()) == sorted(ids)


def test_native_query_has_no_python(spark):
    plan = QUERIES["op10_quality_rules"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
