"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from cohortgram.functions.cleaning import safe_cast, sentinel_to_null
from cohortgram.functions.keys import surrogate_key
from cohortgram.functions.measures import display_status, safe_pct
from cohortgram.functions.statuses import strongest_status, tri_state
from cohortgram.functions.windows import ReportWindow

__all__ = [
    "ReportWindow",
    "display_status",
    "safe_cast",
    "safe_pct",
    "sentinel_to_null",
    "strongest_status",
    "surrogate_key",
    "tri_state",
]
