"""Distinct counts from merged bitmaps are those of count distinct, for every window."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortgram.operators import bitmaps
from cohortgram.plans import Scratch
from cohortgram.plans.windows import in_windows

CELL = ["cohort_id", "g"]


@pytest.fixture(scope="module")
def seen(spark):
    """A third of the rows of one patient; nulls in every column; more patients than a bitmap has bits."""
    choose = random.Random(12)

    def row(i):
        day = datetime(choose.choice([2019, 2020, 2021]), choose.randint(1, 12), choose.randint(1, 28), 23, 59, 59)
        who = "hot" if i % 3 == 0 else f"p{choose.randint(0, 300)}"
        nulls = choose.random()
        return (None if nulls < 0.02 else who, choose.choice(["blood", "urine", None]), choose.choice(["x", "y"]), None if nulls > 0.98 else day)

    some = spark.createDataFrame([row(i) for i in range(3_000)], "patient_key string, cohort_id string, g string, culture_time_shifted timestamp")
    many = spark.range(40_000).select(
        F.concat(F.lit("m"), "id").alias("patient_key"),
        F.lit("blood").alias("cohort_id"),
        F.lit("x").alias("g"),
        F.lit(datetime(2020, 2, 29)).cast("timestamp").alias("culture_time_shifted"),
    )
    return some.unionByName(many)


@pytest.fixture(scope="module")
def stored(spark, seen):
    return bitmaps.monthly_bitmaps(seen, CELL, "patient_key", "culture_time_shifted", Scratch(spark), "bits")


@pytest.mark.parametrize("every", [1, 5, 12, 30])
def test_windows_agree_with_count_distinct(seen, stored, every):
    expected = in_windows(seen, every).groupBy("analysis_window_start", "analysis_window_end_exclusive", *CELL).agg(
        F.count_distinct("patient_key").alias("n")
    )
    got = bitmaps.distinct_by_window(stored, CELL, every, "n")
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.filter("n > 0").collect()))


def test_fewer_columns_and_longer_periods(seen, stored):
    for cell in (["g"], []):
        expected = seen.filter("culture_time_shifted is not null").groupBy(
            *cell, F.year("culture_time_shifted").alias("period")
        ).agg(F.count_distinct("patient_key").alias("n"))
        got = bitmaps.distinct_by_cell(stored, cell, 12, "n")
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_windows_shuffle_bitmaps_and_no_keys(stored):
    plan = bitmaps.distinct_by_window(stored, CELL, 1)._jdf.queryExecution().toString()
    assert "patient_key" not in plan and "distinct" not in plan.replace("distinct_keys", "").lower()


def test_no_rows(spark, seen):
    none = bitmaps.monthly_bitmaps(seen.limit(0), CELL, "patient_key", "culture_time_shifted", Scratch(spark), "none")
    assert bitmaps.distinct_by_window(none, CELL, 1).count() == 0
