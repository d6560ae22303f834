"""The largest keys by bucket totals are those of a full count, on skewed, flat and small tables."""

import pytest
from pyspark.sql import functions as F

from cohortgram.operators import heavy, profile
from cohortgram.plans import Scratch


def agree(spark, rows, keys, top, monkeypatch, buckets=1024):
    """Holds both equal; gives the passes that counted keys and the rows each of them read."""
    passes = []
    counted = heavy.largest_keys

    def watched(narrow, *rest):
        passes.append(narrow.count())
        return counted(narrow, *rest)

    monkeypatch.setattr(heavy, "largest_keys", watched)
    found = heavy.heavy_keys(rows, keys, top, Scratch(spark), buckets=buckets)
    assert found.columns == [*keys, "row_count"]
    assert sorted(map(str, found.collect())) == sorted(map(str, profile.largest_keys(rows, keys, top).collect()))
    return passes


@pytest.fixture
def skewed(spark):
    """A third of the rows in one key, nine more heavy ones, and a long flat tail."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit("hot")).when(i % 3 == 1, F.concat(F.lit("warm"), i % 9)).otherwise(i.cast("string"))
    return spark.range(60_000).select(key.alias("k"), (i % 2).alias("v"))


def test_heavy_keys_are_proved_by_the_first_look(spark, skewed, monkeypatch):
    passes = agree(spark, skewed, ["k"], 3, monkeypatch)
    assert len(passes) == 1 and passes[0] < 45_000


def test_more_keys_than_are_heavy_take_a_second_count(spark, skewed, monkeypatch):
    assert len(agree(spark, skewed, ["k"], 12, monkeypatch)) == 2


def test_flat_table_counts_all_keys(spark, monkeypatch):
    rows = spark.range(20_000).select((F.col("id") % 5_000).alias("k"))
    assert agree(spark, rows, ["k"], 7, monkeypatch)[-1] == 20_000


def test_fewer_keys_than_asked_for_ties_nulls_and_several_keys(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("a", None), ("a", None), (None, 1), (None, 1), (None, None), ("b", 2)] * 3, "k string, row int"
    )
    agree(spark, rows, ["k"], 2, monkeypatch)
    monkeypatch.undo()
    agree(spark, rows, ["k", "row"], 9, monkeypatch)


def test_equal_floating_point_keys_with_unlike_bits(spark, monkeypatch):
    rows = spark.createDataFrame([(0.0, 1), (-0.0, 1), (float("nan"), 1), (1.5, 1)] * 50, "k double, v int")
    agree(spark, rows, ["k"], 1, monkeypatch)
    monkeypatch.undo()
    agree(spark, rows, ["k", "v"], 2, monkeypatch)


def test_no_rows(spark, monkeypatch):
    agree(spark, spark.range(0).select(F.col("id").alias("k")), ["k"], 3, monkeypatch)


def test_bucket_totals_are_what_is_shuffled(spark, skewed):
    """The first pass combines in the task: its exchange carries totals, not keys."""
    hashes = heavy._hashes(skewed.select("k"), 16)
    totals = heavy._totals(skewed.select("k"), hashes)
    assert all(len(side) <= 16 and sum(side.values()) == 60_000 for side in totals)
