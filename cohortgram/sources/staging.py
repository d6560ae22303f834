"""Raw text rows → typed, cleaned rows. Projections only: no shuffle, one pass over the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.cleaning import safe_cast, sentinel_to_null

_INGEST_COLUMNS = ("source_file", "source_version", "ingested_at")


def _identifiers() -> list[Column]:
    return [
        F.col("anon_id").alias("patient_key"),
        F.col("pat_enc_csn_id_coded").alias("encounter_key"),
        F.col("order_proc_id_coded").alias("culture_order_key"),
    ]


def _order_time() -> list[Column]:
    text = F.col("order_time_jittered_utc")
    return [
        text.alias("order_time_jittered_utc_raw"),
        safe_cast(text, "timestamp").alias("culture_time_shifted"),
    ]


def stage_cohort(raw: DataFrame) -> DataFrame:
    cleaned = ("ordering_mode", "culture_description", "organism", "antibiotic")
    return raw.select(
        *_identifiers(),
        *_order_time(),
        *[sentinel_to_null(c).alias(c) for c in cleaned[:2]],
        safe_cast("was_positive", "int").alias("was_positive"),
        *[sentinel_to_null(c).alias(c) for c in cleaned[2:]],
        F.col("susceptibility").alias("susceptibility_raw"),
        # Results compare before trimming: a padded sentinel is kept as text and shows up in the checks.
        sentinel_to_null("susceptibility", compare="raw").alias("susceptibility"),
        *_INGEST_COLUMNS,
    )


def stage_demographics(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_identifiers(),
        F.col("age").alias("age_raw"),
        F.col("gender").alias("gender_raw"),
        sentinel_to_null("age").alias("age"),
        sentinel_to_null("gender").alias("gender"),
        *_INGEST_COLUMNS,
    )


def stage_ward(raw: DataFrame) -> DataFrame:
    flags = ("hosp_ward_IP", "hosp_ward_OP", "hosp_ward_ER", "hosp_ward_ICU")
    return raw.select(
        *_identifiers(),
        *_order_time(),
        *[safe_cast(flag, "int").alias(flag.lower()) for flag in flags],
        *_INGEST_COLUMNS,
    )
