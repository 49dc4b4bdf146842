"""Registered queries against their SQL: names, types and values."""

import duckdb
import pytest

from fareline.llm.queries import ORACLE_SQL, QUERIES
from scripts.compare_oracle import digest, duck_types, spark_types

TABLES = ("documents", "benchmark", "embeddings")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name, sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('/root/testdata/{sf}/{t}.parquet')")
    df = QUERIES[name](spark, f"/root/testdata/{sf}")
    res = c.execute(ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    want = res.fetchall()
    assert spark_types(df) == duck_types(c, ORACLE_SQL[name])
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want) and digest(df.columns, got)[0] == digest(columns, want)[0]


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
