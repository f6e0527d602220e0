"""Every registered query against its SQL in DuckDB, on the same files."""

import os

import duckdb
import pytest

from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    expected = sorted(expected.fetchall(), key=repr)
    # In order: the key comes first, and the rest as declared.
    assert found.columns == columns
    assert expected, "an empty result proves nothing"
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
