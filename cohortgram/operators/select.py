"""Which record of a patient enters a report: the first one in the window, per category or overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgram.functions.keys import surrogate_key
from cohortgram.functions.measures import tally
from cohortgram.functions.statuses import NOT_DETECTED, POSITIVE
from cohortgram.functions.windows import ReportWindow
from cohortgram.operators.consolidate import MEMBERS
from cohortgram.operators.reconcile import RESOLVED, reconcile_group, shared_parent
from cohortgram.reference import (
    E_FAECALIS,
    E_FAECIUM,
    MARKER_DRUGS,
    OVERALL_GROUPS,
    REPORT_SUFFIX,
    S_AUREUS,
    STATUS_COLUMNS,
    SUSCEPTIBLE,
)

PATIENT_GROUP = ("source_version", "cohort_id", "patient_key", "organism_reporting_group")
CATEGORY_KEYS = (*PATIENT_GROUP, "reporting_phenotype")
RECORD_KEY = "reporting_culture_organism_key"


def first_per_group(rows: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group; end ``order`` with a unique key.

    Spark limits every map task to one row per group before the shuffle, so a patient with very many
    rows does not pile up in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def marker_agreement(
    group_endpoints: DataFrame, drugs: Sequence[str] = MARKER_DRUGS, key: str = "reporting_source_key"
) -> DataFrame:
    """Per group: is any marker susceptible, is any marker anything else (stratified scope)."""
    susceptible = (F.col("resolution_status") == RESOLVED) & (F.col("susceptibility") == SUSCEPTIBLE)
    return (
        group_endpoints.filter((F.col("ast_scope") == "stratified") & F.col("antibiotic").isin(*drugs))
        .groupBy(key)
        .agg(
            (tally(susceptible) > 0).alias("any_susceptible_marker"),
            (tally(~F.coalesce(susceptible, F.lit(False))) > 0).alias("any_other_marker"),
        )
    )


def marker_endpoints(records: DataFrame, endpoints: DataFrame, drugs: Sequence[str] = MARKER_DRUGS) -> DataFrame:
    """Group endpoints of the marker drugs for the only records whose category depends on them."""
    parent = shared_parent(records, endpoints)
    groups = records.filter(_is_marker_decided()).select(
        F.lit("stratified").alias("ast_scope"), F.col(RECORD_KEY).alias("reporting_source_key"), *parent, MEMBERS
    )
    return reconcile_group(
        groups,
        endpoints.filter(F.col("antibiotic").isin(*drugs)),
        ("ast_scope", "reporting_source_key"),
        result_sets=False,
        parent=parent,
    )


def _is_marker_decided() -> Column:
    """Records whose category depends on their marker results: base S. aureus judged not resistant."""
    return (
        (F.col("reporting_phenotype") == "base")
        & (F.col("organism_reporting_group") == S_AUREUS)
        & (F.col("ast_oxacillin_resistance_status") == NOT_DETECTED)
    )


def with_markers(records: DataFrame, markers: DataFrame) -> DataFrame:
    """Records with the marker columns of a ``marker_agreement`` table instead of their own."""
    flags = ("any_susceptible_marker", "any_other_marker")
    own = markers.select(F.col("reporting_source_key").alias(RECORD_KEY), *flags)
    return records.drop(*flags).join(own, RECORD_KEY, "left")


def stratified_candidates(records: DataFrame, window: ReportWindow, extra_columns: Sequence[str] = ()) -> DataFrame:
    """Records that may represent a patient in one of the published categories, in one pass.

    The categories exclude each other, so each record is in one of them or none. The susceptible one depends
    on the marker columns of the records.
    """
    phenotype, group = F.col("reporting_phenotype"), F.col("organism_reporting_group")
    eligible = records.filter(window.usable("culture_time_shifted"))
    own_category = (
        ((phenotype == "base") & (group != S_AUREUS))
        | ((phenotype == "esce_r") & (F.col("ast_cre_status") != POSITIVE))
        | ((phenotype == "vancomycin_resistant") & group.isin(E_FAECALIS, E_FAECIUM))
        | ((phenotype == "oxacillin_resistant") & (group == S_AUREUS))
    )
    agreed = F.col("any_susceptible_marker") & ~F.col("any_other_marker")
    category = F.when(own_category, phenotype).when(_is_marker_decided() & agreed, "oxacillin_susceptible")
    suffix = F.try_element_at(F.create_map(*[F.lit(t) for pair in REPORT_SUFFIX.items() for t in pair]), phenotype)
    columns = (RECORD_KEY, *CATEGORY_KEYS, "culture_key", "culture_time_shifted", MEMBERS, *STATUS_COLUMNS)
    return (
        eligible.withColumn("reporting_phenotype", category)
        .filter(phenotype.isNotNull())
        .select(*extra_columns, *columns)
        .withColumn("organism_name", F.concat_ws(" — ", group, suffix))
    )


def first_per_category(candidates: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """The first culture of a patient in each category, chosen without a look at drug results."""
    first = first_per_group(
        candidates, [*extra_keys, *CATEGORY_KEYS], ["culture_time_shifted", "culture_key", RECORD_KEY]
    )
    return first.select(surrogate_key(*CATEGORY_KEYS).alias("first_stratified_reporting_culture_key"), "*")


def first_overall(
    observations: DataFrame, groups: Sequence[str] = OVERALL_GROUPS, extra_keys: Sequence[str] = ()
) -> DataFrame:
    """The first culture of a patient whatever its category, for groups with an overall row."""
    first = first_per_group(
        observations.filter(F.col("organism_reporting_group").isin(*groups)),
        [*extra_keys, *PATIENT_GROUP],
        ["culture_time_shifted", "culture_key"],
    )
    return first.select(
        surrogate_key(*PATIENT_GROUP).alias("overall_reporting_isolate_key"),
        *extra_keys,
        *PATIENT_GROUP,
        F.col("organism_reporting_group").alias("organism_name"),
        "culture_key",
        "culture_time_shifted",
        "reporting_culture_observation_key",
        MEMBERS,
        F.size(MEMBERS).cast("long").alias("source_organism_record_count"),
        "source_reporting_phenotypes",
        "phenotype_records_on_culture",
        *STATUS_COLUMNS,
    )


_ENDPOINT_COLUMNS = (
    "antibiotic",
    "resolution_status",
    "susceptibility",
    "reconciliation_reason",
    "source_endpoint_row_count",
    "source_organisms_with_endpoint",
    "source_conflict_count",
    "source_missing_count",
    "distinct_resolved_result_count",
    "resolved_results",
    "source_resolution_statuses",
)


def attach_endpoints(
    selected: DataFrame,
    group_endpoints: DataFrame,
    scope: str,
    source_key: str,
    selected_key: str,
    key_name: str,
    carry: Sequence[str],
) -> DataFrame:
    """Endpoints of the selected records, taken from one scope only."""
    parent = shared_parent(selected, group_endpoints)
    results = group_endpoints.filter(F.col("ast_scope") == scope).select(
        *parent, F.col("reporting_source_key").alias(source_key), *_ENDPOINT_COLUMNS
    )
    return selected.select(*parent, selected_key, source_key, *carry).join(results, [*parent, source_key]).select(
        surrogate_key(selected_key, "antibiotic").alias(key_name), selected_key, *carry, *_ENDPOINT_COLUMNS
    )


def attach_stratified_endpoints(selected: DataFrame, group_endpoints: DataFrame) -> DataFrame:
    return attach_endpoints(
        selected,
        group_endpoints,
        "stratified",
        RECORD_KEY,
        "first_stratified_reporting_culture_key",
        "first_stratified_reporting_susceptibility_key",
        CATEGORY_KEYS,
    )


def attach_overall_endpoints(selected: DataFrame, group_endpoints: DataFrame) -> DataFrame:
    return attach_endpoints(
        selected,
        group_endpoints,
        "overall",
        "reporting_culture_observation_key",
        "overall_reporting_isolate_key",
        "overall_reporting_susceptibility_key",
        PATIENT_GROUP,
    )
