"""Source labels, reviewed mappings and cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.cleaning import blank_to_null
from cohortgram.functions.keys import surrogate_key
from cohortgram.functions.schemas import ORDER_KEYS
from cohortgram.reference import COHORT_OF_DESCRIPTION

UNMAPPED = "unmapped"
CONTEXT_COLUMNS = ("culture_time_shifted", "culture_description", "was_positive")
MAPPING_COLUMNS = (
    "organism_standardized",
    "organism_reporting_group",
    "source_qualifier",
    "include_primary_summary",
    "mapping_status",
)


def vocabulary(rows: DataFrame, label: str, alias: str | None = None) -> DataFrame:
    return rows.filter(F.col(label).isNotNull()).select(F.col(label).alias(alias or label)).distinct()


def map_labels(rows: DataFrame, mapping: DataFrame, label: str = "organism_source") -> DataFrame:
    """Rows with the reviewed mapping of their exact source label, or marked unmapped.

    The result is a function of the label and the label map, so facts are mapped directly: the map is
    broadcast when its known size allows, and no distinct over the facts is needed first.
    """
    reviewed = mapping.select(
        F.col("organism_source").alias(label),
        "organism_standardized",
        blank_to_null("organism_reporting_group").alias("organism_reporting_group"),
        blank_to_null("source_qualifier").alias("source_qualifier"),
        F.col("include_primary_summary").cast("int").alias("include_primary_summary"),
        "mapping_status",
        "notes",
        F.lit(True).alias("_mapped"),
    )
    mapped = F.col("_mapped").isNotNull()
    return rows.join(reviewed, label, "left").select(
        surrogate_key(label).alias("organism_source_key"),
        *rows.columns,
        "organism_standardized",
        "organism_reporting_group",
        "source_qualifier",
        F.coalesce("include_primary_summary", F.lit(0)).alias("include_primary_summary"),
        F.when(mapped, F.col("mapping_status")).otherwise(UNMAPPED).alias("mapping_status"),
        mapped.alias("has_reviewed_mapping"),
        "notes",
    )


def map_vocabulary(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """The label dimension: every label of the vocabulary with its mapping."""
    return map_labels(labels, mapping)


def cohort_of(description: str | Column, cohorts: dict[str, str] = COHORT_OF_DESCRIPTION) -> Column:
    """Exact, case-sensitive lookup; NULL for any other description."""
    column = F.col(description) if isinstance(description, str) else description
    pairs = [F.lit(text) for pair in cohorts.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), column)


def assign_cohort(
    records: DataFrame, description: str = "culture_description", cohorts: dict[str, str] = COHORT_OF_DESCRIPTION
) -> DataFrame:
    return records.withColumn("cohort_id", cohort_of(description, cohorts)).filter("cohort_id is not null")


def attach_culture_context(
    records: DataFrame, cultures: DataFrame, keys: Sequence[str] = ORDER_KEYS
) -> DataFrame:
    """Time, description and flag of the culture a record belongs to.

    Joined on the natural key, by which the culture roll-up is already partitioned; with the culture key among ``keys``,
    records and cultures that lie by it are joined as they lie.
    """
    return records.join(cultures.select(*keys, *CONTEXT_COLUMNS), list(keys))


def enrich_with_dimension(records: DataFrame, dimension: DataFrame, label: str = "organism") -> DataFrame:
    """Mapping columns of a label dimension on the exact source label, which is kept."""
    columns = ("organism_source_key", "organism_source", *MAPPING_COLUMNS, "has_reviewed_mapping")
    mapped = records.withColumnRenamed(label, "organism_source")
    return mapped.join(dimension.select(*columns), "organism_source")


def reporting_eligible(records: DataFrame) -> DataFrame:
    return records.filter(
        (F.col("include_primary_summary") == 1)
        & (F.col("mapping_status") == "reviewed")
        & F.col("organism_reporting_group").isNotNull()
    )
