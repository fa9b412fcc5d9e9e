"""Every registered query against its SQL in an independent engine."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry.inputs import TABLES
from registry.spark_queries import QUERIES
from registry.sql import ORACLES

SF = "/root/testdata/sf0.001"
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def table_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    df = queries()[key](spark, SF)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    if key in ROWS_ONLY:
        assert got
        return
    result = con.execute(oracle_sql()[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == table_of(names, result.fetchall())


def test_entry(spark):
    assert not entry(spark).isEmpty()
