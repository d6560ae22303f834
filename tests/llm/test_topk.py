import math
import random

import pytest
from pyspark.sql import functions as F

from cohortgram.llm import topk

VECTORS = "vec_id long, embedding array<double>"


def by_brute_force(rows, scale, step, k):
    usable = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in usable:
        if i % step == 0 and (i not in queries or v < queries[i]):
            queries[i] = v
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(frame, scratch, step=5, k=7, block=16, scale=64.0):
    rows = topk.whole_vectors(frame, scale)
    return sorted(tuple(r) for r in topk.search(rows, F.col("vec_id") % step == 0, k, scratch, block).collect())


@pytest.fixture
def rows():
    choose = random.Random(6)
    made = [(i, [choose.choice([-1.0, -0.01, 0.0, 0.3, 0.999]) for _ in range(4)]) for i in range(-20, 280)]
    return [*made, (1000, None), (1005, [1.0, None, 0.0, 0.0]), (1010, [1.0, math.nan, 0.0, 0.0]),
            (1015, [math.inf, 0.0, 0.0, 0.0]), (None, [1.0] * 4), (1020, [1.0, 2.0]), (1021, [3.0, 1.0]), (1025, [])]


def test_agrees_with_brute_force_over_many_tiles(spark, rows, scratch, monkeypatch):
    """Ties everywhere, three levels of merging."""
    monkeypatch.setattr(topk, "FAN", 3)
    assert search(spark.createDataFrame(rows, VECTORS), scratch) == by_brute_force(rows, 64.0, 5, 7)


def test_fewer_candidates_than_asked_for(spark, scratch):
    rows = [(0, [1.0]), (1, [2.0]), (5, [3.0])]
    assert search(spark.createDataFrame(rows, VECTORS), scratch) == by_brute_force(rows, 64.0, 5, 7)


def test_numbers_beyond_doubles_are_exact_or_saturate(spark, scratch):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**12, 1.0]), (2, [2.0**12, 2.0]), (3, [-(2.0**60), 0.0])]
    exact = by_brute_force(rows, 1.0, 5, 7)
    got = search(spark.createDataFrame(rows, VECTORS), scratch, scale=1.0)
    assert got[:2] == exact[:2] and got[2] == (0, 3, 3, 1 - 2**63)


def test_repeated_rows_and_extra_columns(spark, scratch):
    rows = [(5, [1.0, 0.0]), (5, [0.5, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], f"{VECTORS}, block int, score int")
    assert search(frame, scratch) == by_brute_force(rows, 64.0, 5, 7) == [(5, 1, 7, 2048), (5, 2, 7, 2048)]


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(5, None)]])
def test_no_queries(spark, scratch, rows):
    assert search(spark.createDataFrame(rows, VECTORS), scratch) == []
