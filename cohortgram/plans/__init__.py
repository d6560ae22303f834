"""Whole reports put together from the operators."""

from cohortgram.plans.report import ReportTables
from cohortgram.plans.storage import Scratch

__all__ = ["ReportTables", "Scratch"]
