"""Every registered query against its SQL on DuckDB, over whole tables."""

import pytest

import comparing
from tableflow.queries import REGISTRY

FOLDER = "/root/testdata/sf0.01"
SLOW_PLANS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture(scope="module")
def database():
    return comparing.open_duckdb(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, database, name):
    query = REGISTRY[name]
    job = query(spark, FOLDER)
    found = job.toArrow()
    assert query.sql is not None
    assert comparing.differences(found, comparing.run_sql(database, query.sql)) == []
    assert found.num_rows > 0
    assert [word for word in SLOW_PLANS if word in plan(job)] == []


def plan(job):
    return job._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    date_range = plan(REGISTRY["date_range"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1998-04-01T00:00)" in date_range
    revenue = plan(REGISTRY["store_revenue_join"](spark, FOLDER))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" \
        in revenue
    assert "GreaterThanOrEqual(o_orderdate" in plan(REGISTRY["year_part"](spark, FOLDER))


@pytest.mark.parametrize("name", ["topk_actors_join", "most_rented_cte", "top_staff_chain"])
def test_top_k_is_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(REGISTRY[name](spark, FOLDER))


def test_entry_points():
    import __spark_entry__ as entry
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())
