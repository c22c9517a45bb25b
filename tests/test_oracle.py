"""Every registered query against its SQL form in DuckDB, on whole tables."""

import os
from pathlib import Path

import duckdb
import pytest

from tarmac import catalog

FOLDER = os.environ.get("TARMAC_TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["lineitem", "part", "supplier", "nation"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(FOLDER) / f"{table}.parquet"
        connection.execute(f"create view {table} as select * from read_parquet('{path}')")
    return connection


def test_every_query_has_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    result = catalog.queries()[name](spark, FOLDER)
    expected = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    types = [str(d[1]) for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    names = {"bigint": "BIGINT", "string": "VARCHAR"}
    assert {c: names[t] for c, t in result.dtypes} == dict(zip(columns, types))

    def in_order(rows):
        return sorted(rows, key=lambda row: [(v is not None, v) for v in row])

    rows = in_order([tuple(r) for r in result.select(*columns).collect()])
    assert rows
    assert rows == in_order(expected.fetchall())


@pytest.mark.parametrize("name", ["top_models", "departure_delay", "popular_types_all"])
def test_reports_are_in_order(spark, name):
    rows = [tuple(r) for r in catalog.queries()[name](spark, FOLDER).collect()]
    key = (lambda r: (-r[1], r[0])) if name == "top_models" else (lambda r: r[0])
    assert rows == sorted(rows, key=key)
