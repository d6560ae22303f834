"""Comparison by fingerprints against a plain count of rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortgram.operators import compare
from cohortgram.plans import Scratch

SCHEMA = "k1 string, k2 long, v string, w double"
KEYS, VALUES = ["k1", "k2"], ["v", "w"]


def make(count, seed):
    choose = random.Random(seed)
    one_of = lambda *values: choose.choice(values)
    return [(one_of("a", "b", "", None), one_of(*range(40), None), one_of("x", "y", None), one_of(0.5, 1.5, None)) for _ in range(count)]


def by_counting(left, right):
    a, b = Counter(left), Counter(right)
    return sorted(((*row, a[row], b[row]) for row in a | b if a[row] != b[row]), key=repr)


def found(spark, left, right, **more):
    frames = [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (left, right)]
    return sorted((tuple(r) for r in compare.differences(*frames, KEYS, VALUES, **more).collect()), key=repr)


@pytest.mark.parametrize("buckets, leaves", [(1, 1), (3, 2), (8, 1000), (4096, 1 << 18)])
def test_agrees_with_counting_at_any_number_of_buckets(spark, buckets, leaves):
    left = make(300, 1)
    right = [r for i, r in enumerate(random.Random(2).sample(left, len(left))) if i % 50] + make(5, 3) + left[:2]
    expected = by_counting(left, right)
    assert found(spark, left, right, buckets=buckets, leaves=leaves) == expected and len(expected) > 5


def test_equal_swapped_and_empty_sides(spark):
    rows = make(100, 4)
    assert found(spark, rows, rows[::-1]) == []
    assert found(spark, [], []) == []
    assert found(spark, rows, []) == by_counting(rows, []) and found(spark, [], rows) == by_counting([], rows)
    # A NULL in one column is not a NULL in the next, and a repeated row is not one row.
    assert len(found(spark, [("a", 1, None, 1.0)], [("a", 1, "1.0", None)])) == 2
    assert found(spark, rows[:1] * 3, rows[:1]) == [(*rows[0], 3, 1)]


def test_equal_relations_shuffle_sums_only(spark):
    """One changed row of 200,000: the rows of its leaf are all that is compared."""
    frame = spark.range(200_000).select((F.col("id") % 1000).cast("string").alias("k1"), F.col("id").alias("k2"), F.lit("x").alias("v"))
    changed = frame.withColumn("v", F.when(F.col("k2") == 777, "y").otherwise(F.col("v")))
    scratch = Scratch(spark)
    left, right = scratch.keep("left", frame), scratch.keep("right", changed)
    kept = [side.count() for side in compare.suspects(left, right, ["k1", "k2"], ["v"])]
    assert 1 <= kept[0] == kept[1] <= 3
    assert [side.count() for side in compare.suspects(left, left, ["k1", "k2"], ["v"])] == [0, 0]
    got = compare.differences(left, right, ["k1", "k2"], ["v"])
    assert sorted((r.k2, r.v, r.left_rows, r.right_rows) for r in got.collect()) == [(777, "x", 1, 0), (777, "y", 0, 1)]
