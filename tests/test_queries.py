"""Every registered query against its oracle, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in entry.TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    rows = sorted((tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    if name not in ORACLES:
        assert rows
        return
    expected = con.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    listed = ", ".join(f'"{c}"' for c in columns)
    assert rows == sorted(con.sql(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall(), key=repr)
