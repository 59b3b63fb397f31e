"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check
runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.helpers import canon

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_contract_shapes():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pickup_date", "borough", "zone_name", "trip_count", "revenue", "avg_ticket",
                          "avg_miles", "avg_minutes", "card_tip_pct"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, srows) == canon(dcols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    assert df.count() >= 1


PYTHON_ALLOWED = {"generous_borough_pandas_udf"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_plan_has_no_pairwise_joins_or_stray_python(spark, sf_dir, name):
    plan = E.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_ALLOWED:
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
