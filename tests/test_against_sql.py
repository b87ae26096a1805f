"""Every check query against DuckDB on the smallest tables, and a look at its plan."""

import math
from pathlib import Path

import duckdb
import pytest

from checks import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"]


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([comparable(row[i]) for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    found = QUERIES[name](spark, FOLDER)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    wanted = sql.execute(ORACLES[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, wanted.fetchall())
