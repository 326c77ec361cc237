"""Every registered query against its SQL counterpart on the smallest data."""

import datetime
import decimal
import pathlib

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.TEXT_QUERIES)))
def test_query(spark, sql, name):
    frame = entry.queries()[name](spark, str(FOLDER))
    columns = sorted(frame.columns)
    found = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=key)
    allowed = (int, float, str, bool, type(None))
    assert all(isinstance(v, allowed) for r in found[:50] for v in r)
    assert not any(isinstance(v, (decimal.Decimal, datetime.date)) for r in found[:50] for v in r)
    if name not in ORACLES:
        assert found
        return
    relation = sql.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    assert found == sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=key)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 7
