"""Queries with SQL against it, on the smallest data."""

import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from cohortgram.llm import registry

sys.path.insert(0, str(Path(entry_point.__file__).parent / "tools"))

from check_queries import TABLES, multiset  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    frame = entry_point.queries()[name](spark, SMALL)
    result = database.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert multiset(frame.columns, [tuple(r) for r in frame.collect()]) == multiset(columns, result.fetchall())
