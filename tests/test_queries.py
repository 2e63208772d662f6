"""Every query with a SQL form against DuckDB on the smallest tables."""

import datetime
import math
import os

import pytest

import __spark_entry__ as entry
from tidemark.plans import gateway, sql_queries
from tidemark.plans.sql_queries import TABLES

duckdb = pytest.importorskip("duckdb")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query(spark, duck, sf_dir, name):
    found = entry.queries()[name](spark, sf_dir)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    mine = sorted(tuple(norm(r[c]) for c in sorted(columns)) for r in found.collect())
    assert mine == sorted(tuple(norm(r[columns.index(c)]) for c in sorted(columns)) for r in cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("limit", ["LIMIT 1", "LIMIT 2 OFFSET 1"])
def test_lateral_limit_follows_its_order(spark, sf_dir, limit):
    for t in ("customer", "orders"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    one = f"SELECT c_custkey, x.o_orderkey AS k FROM customer, LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC {limit}) x"
    for frame in (sql_queries.run(spark, sf_dir, one), sql_queries.run(spark, sf_dir, f"SELECT * FROM ({one}) a UNION ALL SELECT 0, 0"), gateway.Gateway(spark).frame(one)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        numbered = [line for line in plan.split("\n") if "row_number() windowspecdefinition" in line]
        assert numbered and all("o_orderdate" in line and "o_orderkey" in line for line in numbered), plan  # else a cluster's shuffle decides which rows come first
    assert entry.oracle_sql()["sql_lateral"] == sql_queries.SQL["sql_lateral"][0]
