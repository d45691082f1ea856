"""Every registered ledger query against its SQL in DuckDB, at the smallest scale."""

import datetime
import decimal
import os

import duckdb
import pytest

from chainloom.plans import registry

DATA = os.environ.get("LEDGER_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def in_order(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = registry.QUERIES[name](spark, DATA)
    if name not in registry.ORACLES:
        assert frame.count() > 0
        return
    found = duck.sql(registry.ORACLES[name])
    assert sorted(found.columns) == sorted(frame.columns)
    columns = sorted(frame.columns)
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLES[name]})").fetchall()
    assert in_order(frame.select(*columns).collect()) == in_order(expected)


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
