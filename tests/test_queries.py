"""Registered queries against their SQL oracles on the smallest tables, and their plans."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from cartulary.workload.oracles import ORACLES
from cartulary.workload.queries import QUERIES

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def _comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, duck, name):
    found = QUERIES[name](spark, str(TABLES))
    plan = found._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert forbidden not in plan
    cursor = duck.execute(ORACLES[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    ours = _comparable(found.columns, [tuple(row) for row in found.collect()])
    assert ours == _comparable(columns, cursor.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
