"""Registered training-data queries against their DuckDB SQL."""

import os
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.llm import oracle_sql, queries

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tools.oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = oracle_sql.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_operator_is_registered():
    names = E.queries()
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = queries.queries()[name](spark, SF)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert Counter(rows_of(df.columns, [tuple(r) for r in df.collect()])) == Counter(
        rows_of(columns, result.fetchall()))
