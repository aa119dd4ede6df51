"""Every query against its SQL twin on the smallest tables."""

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_point
from rowsmith.plans.catalog import ENTRIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: found.run for name, found in ENTRIES.items()}
SQL = {name: found.sql for name, found in ENTRIES.items() if found.sql is not None}
# Whole jobs are run by tests/test_jobs.py.
JOBS = {
    "severity_job", "severity_job_single_machine", "severity_job_fitted_on_train",
    "intrusion_job", "intrusion_scores",
}
# No pair of tables is crossed, and no row passes through Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "BatchEvalPython")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    assert differences(frame, connection, SQL[name]) == []
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - JOBS))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["part_of_day", "day_flag", "n", "mean_freq", "percent"]
    assert df.count() > 0
