"""Queries of these operators that have SQL, against it on the smallest test tables."""

import duckdb
import pytest

from compare import TABLES, bag
from vigilframe.llm.oracles import ORACLES
from vigilframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    ours = bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    assert ours == bag([d[0] for d in cursor.description], cursor.fetchall())


def test_mixing_stays_in_the_jvm(spark):
    plan = QUERIES["op2_mixing"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
