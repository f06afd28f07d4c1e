"""Every registered query against its DuckDB oracle on the smallest tables,
plus plan checks over all of them."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from courierlake.oracle import ORACLE_SQL
from courierlake.registry import QUERIES
from scripts.compare import TABLES, digest
from tests.conftest import SF_SMALL


# The smallest tables select no key, so that query discovers no code there.
SF_OF = {"q10b_latest_per_code_discovered": "/root/testdata/sf0.01"}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    sf_dir = SF_OF.get(name, SF_SMALL)
    duck, df = connect(sf_dir), entry.queries()[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    duck.execute(f"CREATE OR REPLACE VIEW oracle AS {entry.oracle_sql()[name]}")
    res = duck.execute("SELECT * FROM oracle")
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_cross_join_in_plans(spark, name):
    plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 57 and df.count() >= 0


def test_vehicle_join_is_broadcast(spark):
    plan = entry.queries()["q05_visit_mart"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BroadcastExchange" in plan
