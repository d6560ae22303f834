"""Cohort reporting on Spark: susceptibility and resistance tables from long-form result rows."""

from cohortgram.functions.windows import ReportWindow

__all__ = ["ReportWindow"]
