"""Counts over many windows by intervals against the form that copies records."""

from datetime import date, datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from cohortgram.operators import sweep
from cohortgram.plans import ReportTables, Scratch, windows
from cohortgram.queries import source
from cohortgram.sources.seeds import Seeds

SMALL = "/root/testdata/sf0.001"
MONTHLY = [date(y, m, 1) for y in range(1992, 1999) for m in range(1, 13)]
ODD = [date(1996, 2, 29), date(1997, 1, 31), date(1997, 2, 1), date(1993, 5, 17), date(1997, 1, 31)]


@pytest.fixture(scope="module")
def tables(spark):
    scratch = Scratch(spark)
    return ReportTables(scratch.keep("raw", source.raw_cohort(spark, SMALL)), Seeds.built_in(spark), scratch=scratch)


@pytest.mark.parametrize("starts", [MONTHLY, ODD, 1, 5, 12, 24, []], ids=["monthly", "odd", "1", "5", "12", "24", "none"])
def test_tables_are_those_of_copied_records(tables, rows, starts):
    for swept, copied in (
        (windows.susceptibility_by_window, windows.copied_susceptibility_by_window),
        (windows.mdro_by_window, windows.copied_mdro_by_window),
    ):
        expected = copied(tables, starts)
        columns = sorted(expected.columns)
        found = swept(tables, starts)
        assert sorted(found.columns) == columns
        assert rows(found, *columns) == rows(expected, *columns)


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_no_record_is_copied_to_windows(tables):
    """The only explodes by window stand above the counts; records are read without one."""
    text = plan(windows.susceptibility_by_window(tables, 1))
    for line in (x for x in text.splitlines() if "Generate explode" in x):
        assert "sequence(_at" in line or "source_culture_organism_keys" in line, line
    assert "Generate explode" in plan(windows.copied_susceptibility_by_window(tables, 1))


def test_first_in_each_window_by_brute_force(spark):
    """Ties, times on a window's start, groups with one row and with very many, and null times."""
    choose = Random(2)
    base = datetime(1995, 1, 1)
    data = [(choose.choice("abc"), base + timedelta(days=choose.randint(0, 1500)), i) for i in range(60)]
    data += [("hot", base + timedelta(days=choose.randint(0, 900)), 100 + i) for i in range(300)]
    data += [("d", datetime(1996, 1, 1), 500), ("d", datetime(1997, 1, 1), 501), ("d", datetime(1997, 1, 1), 502), ("e", None, 503)]
    frame = spark.createDataFrame(data, "who string, at timestamp, id int")
    for starts in (1, 7, ODD, MONTHLY):
        grid = sweep.WindowGrid.of(starts)
        found = sweep.first_in_windows(frame, ["who"], ["at", "id"], grid, "at")
        spread = found.select("who", "id", F.explode(F.sequence("first_window", F.col("end_window") - 1)).alias("w"))
        spread = spread.select("who", "id", grid.start("w").alias("start")).collect()
        copies = windows.in_windows(frame, starts, "at").collect()
        expected = {}
        for r in sorted(copies, key=lambda r: (r["at"], r["id"])):
            expected.setdefault((r["who"], r[sweep.WINDOW_KEYS[0]]), r["id"])
        assert {(r["who"], r["start"]): r["id"] for r in spread} == expected and len(spread) == len(expected)
        counted = sweep.counts_by_window(found, ["who"], [F.count("id").alias("n")], ["n"], grid).collect()
        assert {(r["who"], r[sweep.WINDOW_KEYS[0]]): r["n"] for r in counted} == dict.fromkeys(expected, 1)
