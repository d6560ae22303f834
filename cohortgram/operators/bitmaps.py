"""Exact distinct counts of many overlapping windows from one pass over the rows, by bitmaps that merge.

A row per key holds the cells and months it is seen in, gathered in one shuffle in which each task sends a key's cell and month
once. These rows are numbered and stored; a cell's month is then a set of numbers, kept as bitmaps of 32,768 numbers each. The distinct keys
of a window are the bits of the OR of its months' bitmaps, so windows that overlap share all work but that.

Numbers are dense within a stored partition, where keys stand by their first month: keys of one time share bitmaps, and months far from
it have none there. A bitmap takes 4 KB however few bits it has, so this form is for cells with many keys a month; for
sparse ones ``sweep`` counts first rows instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.windows import WINDOW_MONTHS
from cohortgram.operators.sweep import WINDOW_KEYS
from cohortgram.plans.storage import Scratch

#: Columns that make up a bitmap beside its cell; months are counted from the year 0.
MONTH, BUCKET, BITS = "month_number", "bucket", "bits"


def monthly_bitmaps(rows: DataFrame, cell: Sequence[str], key: str, time: str, scratch: Scratch, name: str) -> DataFrame:
    """``cell``, month, bucket and bitmap of the keys seen. Rows without a key or a time count nowhere; null is a cell value like others.

    The work of the windows starts from the stored result.
    """
    month = (F.year(time) * 12 + F.month(time) - 1).alias(MONTH)
    seen = (
        rows.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
        .select(F.col(key).alias("_key"), F.struct(month, *cell).alias("_seen"))
        .groupBy("_key")
        .agg(F.collect_set("_seen").alias("_seen"))
    )
    ordered = seen.select("_seen", F.array_min(F.transform("_seen", lambda s: s[MONTH])).alias("_first"))
    # Stored, so that a lost task cannot number its keys anew after others have read them.
    numbered = scratch.keep(
        f"{name}-numbered",
        ordered.sortWithinPartitions("_first").select("_seen", (F.monotonically_increasing_id() + 1).alias("_number")),
    )
    bits = numbered.select(
        F.bitmap_bucket_number("_number").alias(BUCKET),
        F.bitmap_bit_position("_number").alias("_position"),
        F.explode("_seen").alias("_seen"),
    )
    cells = bits.select(BUCKET, "_position", "_seen.*")
    return scratch.keep(name, cells.groupBy(*cell, MONTH, BUCKET).agg(F.bitmap_construct_agg("_position").alias(BITS)))


def distinct_by_window(bitmaps: DataFrame, cell: Sequence[str], every: int, count: str = "distinct_keys") -> DataFrame:
    """Distinct keys per cell in each twelve-month window that starts on the first day of every so many months from the year 0.

    Windows in which a cell has none are left out.
    """
    last = F.floor(F.col(MONTH) / every)
    first = F.floor((F.col(MONTH) - WINDOW_MONTHS) / every) + 1
    # With fewer windows than months, a month may be in none.
    held = bitmaps.filter(first <= last).withColumn("_window", F.explode(F.sequence(first, last)))
    merged = held.groupBy(*cell, "_window", BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    counted = _counted(merged, [*cell, "_window"], count)
    month = F.col("_window") * every
    start = F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1))
    return counted.select(
        start.alias(WINDOW_KEYS[0]), F.add_months(start, WINDOW_MONTHS).alias(WINDOW_KEYS[1]), *cell, count
    )


def distinct_by_cell(bitmaps: DataFrame, cell: Sequence[str], months: int, count: str = "distinct_keys") -> DataFrame:
    """Distinct keys per period of so many months and per ``cell``, which may be fewer columns than the bitmaps have."""
    period = F.floor(F.col(MONTH) / months).cast("int").alias("period")
    merged = bitmaps.groupBy(*cell, period, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return _counted(merged, [*cell, "period"], count)


def _counted(merged: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(count))
