"""The optional twelve-month reporting window."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_MONTHS = 12


def add_months(day: date, months: int) -> date:
    month = day.month - 1 + months
    year, month = day.year + month // 12, month % 12 + 1
    return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


@dataclass(frozen=True)
class ReportWindow:
    """Inclusive start and exclusive end. Without a start the whole release is reported."""

    start: date | None = None

    @classmethod
    def parse(cls, text: str | date | None) -> ReportWindow:
        if text is None or isinstance(text, date):
            return cls(text)
        return cls(date.fromisoformat(text.strip())) if text.strip() else cls()

    @property
    def end(self) -> date | None:
        return None if self.start is None else add_months(self.start, WINDOW_MONTHS)

    def covers(self, time: str | Column) -> Column:
        """True for times in the window. Literal bounds on the bare column reach the file scan."""
        if self.start is None:
            return F.lit(True)
        column = F.col(time) if isinstance(time, str) else time
        return (column >= F.lit(self.start).cast("timestamp")) & (column < F.lit(self.end).cast("timestamp"))

    def usable(self, time: str) -> Column:
        """The window plus the rule that rows without a time never enter a report."""
        return F.col(time).isNotNull() & self.covers(time)

    def columns(self) -> list[Column]:
        return [
            F.lit(self.start).cast("date").alias("analysis_window_start"),
            F.lit(self.end).cast("date").alias("analysis_window_end_exclusive"),
        ]
