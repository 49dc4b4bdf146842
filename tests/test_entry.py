"""Driver contract: entry, registered queries and their DuckDB oracle (sf0.001)."""

import os

import duckdb
import pytest

from helpers import SF001

import __spark_entry__ as E
from fareline.plans import registry
from scripts.compare_oracle import TABLES, digest, duck_types, spark_types


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "net_revenue" in df.columns


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[name]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
    assert spark_types(df) == duck_types(con, sql)
