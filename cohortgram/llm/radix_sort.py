"""A distributed stable radix sort that gives every row its place, least significant digit first.

Rows have integer keys, the least significant first, each cut into digits of ``DIGIT`` bits. A pass over one digit is a
counting sort: rows are counted per part and digit, prefix sums of the counts say where the rows of a part with a digit
begin, and each part deals its rows out from there in the order they had. The place a row gets is dense, so the next pass cuts the rows into
parts by place: all parts are of one size whatever the keys, and no key, however frequent, makes one larger. Each pass
shuffles the rows once and is written to the shared folder, which cuts the lineage. Digits in which all rows agree are
left out.

A part holds ``rows / parts`` rows in a task, at most ``PART``. The counts have at most ``parts * 2**DIGIT`` rows and are summed up by Spark;
only one number per digit value goes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from cohortgram.plans.storage import Scratch

DIGIT = 12
#: The most rows of a part; more rows make more parts.
PART = 1 << 20

_SIGN = -(1 << 63)


def unsigned(value: Column) -> Column:
    """A long whose bits, read without sign, are in the order of ``value``."""
    return value.bitwiseXOR(F.lit(_SIGN).cast("long"))


def _digit(key: str, shift: int) -> Column:
    return F.shiftrightunsigned(key, shift).bitwiseAND(F.lit((1 << DIGIT) - 1).cast("long"))


def _begins(counts: DataFrame) -> DataFrame:
    """``of_part, of_digit, begin``: the place of the first row of each part with each digit."""
    # One row per digit value, at most 2**DIGIT of them.
    totals = sorted(counts.groupBy("digit").agg(F.sum("n")).collect())
    before = np.cumsum([0, *(n for _, n in totals[:-1])]).tolist() if totals else []
    firsts = counts.sparkSession.createDataFrame(
        [(d, b) for (d, _), b in zip(totals, before)], "digit long, first long"
    )
    earlier = Window.partitionBy("digit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("first") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return counts.join(firsts, "digit").select(
        F.col("part").alias("of_part"), F.col("digit").alias("of_digit"), begin.alias("begin")
    )


def _pass(rows: DataFrame, schema: StructType, key: str, shift: int, size: int) -> DataFrame:
    dealt = rows.withColumn("digit", _digit(key, shift))
    counts = dealt.groupBy("part", "digit").agg(F.count(F.lit(1)).alias("n"))

    def deal(part: pa.Table, begins: pa.Table) -> pa.Table:
        begin = np.zeros(1 << DIGIT, np.int64)
        begin[begins["of_digit"].to_numpy()] = begins["begin"].to_numpy()
        # Back into the order of the pass before: places are unique, and dense after the first pass.
        part = part.take(pa.array(np.argsort(part["place"].to_numpy(), kind="stable")))
        digit = part["digit"].to_numpy()
        order = np.argsort(digit.astype(np.uint16), kind="stable")  # numpy counts here, too
        held = np.bincount(digit, minlength=1 << DIGIT)
        within = np.arange(len(digit)) - np.repeat(np.cumsum(held) - held, held)
        place = np.empty(len(digit), np.int64)
        place[order] = begin[digit[order]] + within
        new = {"place": pa.array(place), "part": pa.array(place // size)}
        return pa.table({n: new.get(n, part[n]) for n in schema.names})

    return dealt.groupBy("part").cogroup(_begins(counts).groupBy("of_part")).applyInArrow(deal, schema)


def places(rows: DataFrame, keys: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """The rows with ``place``: 0, 1, 2, ... in ascending order of the keys, the last of ``keys`` the most significant.

    Keys are longs without nulls, compared without sign (``unsigned`` makes them). Rows with equal keys follow each other in no
    set order. ``rows`` has no columns ``place``, ``part`` or ``digit`` and should be stored, as it is read several times.
    """
    spark = rows.sparkSession
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.bit_or(k).bitwiseXOR(F.bit_and(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    ).first()
    count = facts["n"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // PART))
    size = max(1, -(-count // parts))
    schema = StructType([*rows.schema.fields]).add("place", LongType()).add("part", LongType())
    # Before the first pass any order is as good as another; a hash of the row's number spreads equal rows.
    numbered = rows.withColumn("place", F.monotonically_increasing_id())
    state = numbered.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(parts)))
    state = scratch.keep(f"{name}_0", state)
    turn = 0
    for i, key in enumerate(keys):
        differing = (facts[f"k{i}"] or 0) & ((1 << 64) - 1)
        for shift in range(0, 64, DIGIT):
            if differing >> shift & ((1 << DIGIT) - 1):
                turn += 1
                state = scratch.keep(f"{name}_{turn}", _pass(state, schema, key, shift, size))
    if not turn:
        # All rows are equal: places by part, then by order inside it, without a digit to sort by.
        state = scratch.keep(f"{name}_1", _pass(state, schema, keys[0], 0, size))
    return state.drop("part")
