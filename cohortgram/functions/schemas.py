"""Explicit schemas: sources arrive as text, staging adds the types."""

from __future__ import annotations

from pyspark.sql import types as T


def all_strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# The column names of the three raw files.
ORDER_ID_COLUMNS = ("anon_id", "pat_enc_csn_id_coded", "order_proc_id_coded")
COHORT_SCHEMA = all_strings(
    *ORDER_ID_COLUMNS,
    "order_time_jittered_utc",
    "ordering_mode",
    "culture_description",
    "was_positive",
    "organism",
    "antibiotic",
    "susceptibility",
)
DEMOGRAPHICS_SCHEMA = all_strings(*ORDER_ID_COLUMNS, "age", "gender")
WARD_SCHEMA = all_strings(
    *ORDER_ID_COLUMNS, "order_time_jittered_utc", "hosp_ward_IP", "hosp_ward_OP", "hosp_ward_ER", "hosp_ward_ICU"
)

ORDER_KEYS = ("source_version", "patient_key", "encounter_key", "culture_order_key")
