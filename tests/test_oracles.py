"""Every registered query of the core against its DuckDB oracle on sf0.001 (the driver
runs the same check on sf0.01); the removable subpackage tests its own."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from docrank.plans.catalog import QUERIES
from docrank.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "part orders lineitem events documents pages benchmark conversations".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = df.collect()
    cur = con.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_rows_only_queries_run(spark):
    for name in set(QUERIES) - set(ORACLE_SQL):
        assert QUERIES[name](spark, SF).count() >= 0
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "similarity"]
    assert df.count() == 200
