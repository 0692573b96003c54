"""Every registered query against its SQL counterpart, and the shape of its plan."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracles import ORACLES
from checks.queries import QUERIES
from compare import TABLES, bag

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|EvalPython|InPandas|MapInArrow|InArrow|CartesianProduct|BroadcastNestedLoopJoin", plan)
    ours = bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = sql.execute(ORACLES[name])
    assert ours == bag([d[0] for d in cursor.description], cursor.fetchall())


def test_entry_registers_them():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() == 150


def test_scans_are_pruned_and_filtered(spark):
    plan = QUERIES["listing_pivot"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp>" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan
