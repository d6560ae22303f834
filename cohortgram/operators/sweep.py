"""Counts over many overlapping windows without a copy of a row for each of them.

A row is the first of its group in exactly the windows that start after the row before it and not after its own time, as long as
they still hold that time. Windows are numbered by their start, so those of a row are one interval of numbers. A count per window
is then a running sum: plus one where the interval of a row begins, minus one where it ends. Work and shuffles follow rows and
results, not rows times windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgram.functions.windows import WINDOW_MONTHS
from cohortgram.operators.select import first_per_group

WINDOW_KEYS = ("analysis_window_start", "analysis_window_end_exclusive")
#: The numbers of a row's windows: the first, and the one after the last.
SPAN = ("first_window", "end_window")


@dataclass(frozen=True)
class WindowGrid:
    """Twelve-month windows numbered by their start.

    ``starts`` are dates, or a number of months: then a window starts on the first day of every so many months, counted from the
    year 0, and neither the plan nor the driver counts them.
    """

    starts: tuple[date, ...] | int

    @classmethod
    def of(cls, starts: Sequence[date] | int) -> WindowGrid:
        return cls(starts if isinstance(starts, int) else tuple(sorted(set(starts))))

    def _listed(self) -> Column:
        return F.lit(list(self.starts)).cast("array<date>")

    def latest(self, time: str) -> Column:
        """Number of the last window that starts at or before a time; -1 if none does."""
        if isinstance(self.starts, int):
            return F.floor((F.year(time) * 12 + F.month(time) - 1) / self.starts).cast("int")
        return F.size(F.filter(self._listed(), lambda s: F.col(time) >= s)) - 1

    def earliest(self, time: str) -> Column:
        """Number of the first window that ends after a time."""
        if isinstance(self.starts, int):
            month = F.year(time) * 12 + F.month(time) - 1
            return (F.floor((month - WINDOW_MONTHS) / self.starts) + 1).cast("int")
        return F.size(F.filter(self._listed(), lambda s: F.col(time) >= F.add_months(s, WINDOW_MONTHS)))

    def start(self, number: str) -> Column:
        if isinstance(self.starts, int):
            month = F.col(number) * self.starts
            return F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1))
        return F.get(self._listed(), F.col(number))


def first_in_windows(
    rows: DataFrame, partition: Sequence[str], order: Sequence[str], grid: WindowGrid, time: str = "culture_time_shifted"
) -> DataFrame:
    """The rows that are the first of their group in some window, with the interval of these windows (``SPAN``).

    Of the rows of a group between two window starts only the first can be one. Spark keeps one of them in each task before the
    shuffle, so a group with very many rows comes down to one row per window start before its rows are put in order.
    """
    numbered = rows.filter(F.col(time).isNotNull()).withColumn("_latest", grid.latest(time))
    first = first_per_group(numbered, [*partition, "_latest"], order)
    before = F.lag("_latest").over(Window.partitionBy(*partition).orderBy("_latest"))
    begin = F.greatest(grid.earliest(time), F.coalesce(before + 1, grid.earliest(time)))
    spans = first.withColumns({SPAN[0]: begin, SPAN[1]: F.col("_latest") + 1})
    return spans.filter(f"{SPAN[0]} < {SPAN[1]}").drop("_latest")


def counts_by_window(
    rows: DataFrame, keys: Sequence[str], counts: Sequence[Column], names: Sequence[str], grid: WindowGrid
) -> DataFrame:
    """Aggregates that add up (``counts``, called ``names``) over the rows of each window, per ``keys`` and window.

    Windows in which the first of them is 0 are left out.
    """
    edges = F.array(
        F.struct(F.col(SPAN[0]).alias("_at"), F.lit(1).alias("_sign")), F.struct(F.col(SPAN[1]).alias("_at"), F.lit(-1).alias("_sign"))
    )
    changes = rows.select("*", F.inline(edges)).groupBy(*keys, "_at", "_sign").agg(*counts)
    order = Window.partitionBy(*keys).orderBy("_at", "_sign")
    sums = [F.sum(F.col("_sign") * F.col(n)).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n in names]
    held = changes.select(*keys, "_at", F.lead("_at").over(order).alias("_until"), *sums)
    # The sums hold until the next change; of several changes at one number the last one's.
    spread = held.filter((F.col("_at") < F.col("_until")) & (F.col(names[0]) > 0)).select(
        *keys, *names, F.explode(F.sequence("_at", F.col("_until") - 1)).alias("_window")
    )
    start = grid.start("_window")
    return spread.select(
        start.alias(WINDOW_KEYS[0]), F.add_months(start, WINDOW_MONTHS).alias(WINDOW_KEYS[1]), *keys, *names
    )
