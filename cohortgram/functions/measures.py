"""Counts, guarded percentages and the display threshold."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: smallest number of categorised results a row needs to be shown.
DISPLAY_MINIMUM = 30


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_pct(part: str | Column, whole: str | Column, digits: int = 1) -> Column:
    """Percentage in exact decimal arithmetic; NULL (never 0) when there is no denominator."""
    ratio = F.lit(Decimal("100.0")) * _column(part) / F.nullif(_column(whole), F.lit(0))
    return F.round(ratio, digits).cast("double")


def display_status(count: str | Column, minimum: int = DISPLAY_MINIMUM) -> Column:
    return F.when(_column(count) >= minimum, "display").otherwise("insufficient_data")


def n_rows() -> Column:
    return F.count(F.lit(1))


def tally(condition: Column) -> Column:
    """Number of rows for which ``condition`` is true; NULL counts as not true."""
    return F.count_if(condition)
