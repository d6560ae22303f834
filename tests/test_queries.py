"""Every query against its SQL, on the smallest data."""

import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from cohortgram.queries.registry import load_all

sys.path.insert(0, str(Path(entry_point.__file__).parent / "tools"))

from check_queries import TABLES, multiset  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return connection


def test_every_report_query_has_sql():
    assert set(load_all()) <= set(ORACLES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query(spark, database, name):
    frame = entry_point.queries()[name](spark, SMALL)
    result = database.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert multiset(frame.columns, [tuple(r) for r in frame.collect()]) == multiset(columns, result.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
