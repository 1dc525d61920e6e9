"""Each registered query against its DuckDB statement, on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from fixtures.oracle import oracle_sql
from fixtures.queries import queries
from quitanda.plans.marts import MARTS

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_its_oracle(spark, tables, name):
    frame = queries()[name](spark, SF_DIR)
    oracle = tables.sql(oracle_sql()[name])
    assert sorted(frame.columns) == sorted(oracle.columns)
    got = [tuple(row) for row in frame.select(*oracle.columns).collect()]
    expected = oracle.fetchall()
    if name in MARTS:
        assert got == expected
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_all_are_registered():
    assert set(queries()) <= set(entry.queries())
    assert set(oracle_sql()) <= set(entry.oracle_sql()) <= set(entry.queries())
