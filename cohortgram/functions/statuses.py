"""The four evidence statuses and how they merge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, strongest first: a status that could not be judged outranks a negative one.
POSITIVE = "positive"
NOT_EVALUABLE = "not_evaluable"
NOT_DETECTED = "not_detected"
NOT_APPLICABLE = "not_applicable"


def status_rank(status: str | Column) -> Column:
    """1 for the strongest status; text outside the three judged statuses ranks last."""
    column = F.col(status) if isinstance(status, str) else status
    return F.when(column == POSITIVE, 1).when(column == NOT_EVALUABLE, 2).when(column == NOT_DETECTED, 3).otherwise(4)


def status_of_rank(rank: Column, fallback: str | None = NOT_APPLICABLE) -> Column:
    return F.when(rank == 1, POSITIVE).when(rank == 2, NOT_EVALUABLE).when(rank == 3, NOT_DETECTED).otherwise(
        F.lit(fallback).cast("string")
    )


def strongest_status(status: str | Column, fallback: str | None = NOT_APPLICABLE) -> Column:
    """Aggregate: the strongest status of a group, as a plain ``min`` with a map-side partial."""
    return status_of_rank(F.min(status_rank(status)), fallback)


def tri_state(status: str | Column) -> Column:
    """positive → true, not_detected → false, anything else → NULL."""
    column = F.col(status) if isinstance(status, str) else status
    return F.when(column == POSITIVE, True).when(column == NOT_DETECTED, False)
