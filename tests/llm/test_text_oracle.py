"""Queries with SQL against DuckDB."""

import math
import os

import duckdb
import pytest
from __spark_entry__ import oracle_sql, queries

from tidemark.llm.queries import SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal_sql(spark, tables, name):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = tables.execute(oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns

    def row(values):
        return tuple(round(v, 9) if isinstance(v, float) and math.isfinite(v) else v for v in values)

    expected = sorted((row(r[names.index(c)] for c in columns) for r in found.fetchall()), key=repr)
    assert sorted((row(r[c] for c in columns) for r in df.collect()), key=repr) == expected
