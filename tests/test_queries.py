"""Every registered query against its SQL in DuckDB, and the shape of its plan."""

import importlib
import math

import duckdb
import pytest

from spanwatch.plans.oracle import oracle_sql
from spanwatch.plans.queries import GIVEN, all_queries

SF_DIR = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def sort_key(row):
    return [(value is not None, str(value)) for value in row]


def test_every_query_has_its_sql():
    assert all_queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck, name):
    frame = all_queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in frame.collect()]
    result = duck.execute(oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    names = [d[0] for d in result.description]
    expected = [tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()]
    assert columns == sorted(names)
    assert {c: TYPES[t] for c, t in frame.dtypes} == types
    assert sorted(got, key=sort_key) == sorted(expected, key=sort_key)
    assert got, "a check on no rows shows nothing"

    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert unwanted not in plan


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__").entry(spark)
    assert entry.columns[:2] == ["sensor_id", "label"] and entry.count() > 0
