"""Source records of one culture → one record per reporting group and phenotype, then per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.keys import surrogate_key
from cohortgram.functions.measures import n_rows
from cohortgram.functions.statuses import status_of_rank, status_rank, strongest_status, tri_state
from cohortgram.functions.windows import ReportWindow
from cohortgram.operators.evidence import MARKER_FLAGS, display_name, priority_label
from cohortgram.operators.vocabulary import reporting_eligible
from cohortgram.reference import MARKER_DRUGS, RULES, SOURCE_DESIGNATIONS, STATUS_COLUMNS

CULTURE_COLUMNS = (
    "patient_key",
    "encounter_key",
    "culture_order_key",
    "culture_time_shifted",
    "culture_description",
    "was_positive",
)
RECORD_KEYS = ("source_version", "cohort_id", "culture_key", "organism_reporting_group", "reporting_phenotype")
MEMBERS = "source_culture_organism_keys"


def categorised_records(phenotypes: DataFrame) -> DataFrame:
    """Reportable records with their reporting phenotype and display name."""
    return reporting_eligible(phenotypes).select(
        "*", priority_label().alias("reporting_phenotype"), display_name().alias("organism_name")
    )


def consolidate(
    records: DataFrame,
    keys: Sequence[str] = RECORD_KEYS,
    statuses: Sequence[str] = STATUS_COLUMNS,
    audit_columns: bool = True,
) -> DataFrame:
    """One row per culture, group and phenotype.

    The members of a row are the labels one culture has inside one reporting group, so the label map
    bounds them; nearly always there is one. They are listed once, and sets, counts and merged statuses
    are read off that short list. Culture columns depend on the culture key and ride along as keys.
    Reports need the member keys and statuses; the rest is for audits.
    """
    sets = {
        MEMBERS: "culture_organism_key",
        "source_labels": "organism_source",
        "standardized_identities": "organism_standardized",
        "source_qualifiers": "source_qualifier",
    }
    designations = [flag for flag, _, _ in SOURCE_DESIGNATIONS]
    carried = [*CULTURE_COLUMNS, "organism_name"]
    if not audit_columns:
        sets, designations, carried = {MEMBERS: sets[MEMBERS]}, [], ["patient_key", "culture_time_shifted"]
    markers = [F.coalesce(flag, F.lit(False)).alias(flag) for flag in MARKER_FLAGS]
    member = F.struct(*sets.values(), *[status_rank(s).alias(s) for s in statuses], *designations, *markers)
    # The culture key first: sorts tell rows apart by the first column.
    by = sorted(keys, key=lambda k: k != "culture_key")
    members = F.col("members")
    rolled = (
        records.groupBy(*by, *carried)
        .agg(F.collect_list(member).alias("members"))
        .select(
            surrogate_key(*keys).alias("reporting_culture_organism_key"),
            *keys,
            *carried,
            *[
                F.array_sort(F.array_distinct(F.array_compact(members[source]))).alias(name)
                for name, source in sets.items()
            ],
            *[status_of_rank(F.array_min(members[s])).alias(s) for s in statuses],
            *[F.array_max(members[flag]).alias(flag) for flag in designations],
            *marker_results(members),
        )
    )
    if not audit_columns:
        return rolled
    return rolled.select(
        "reporting_culture_organism_key",
        *keys,
        *carried,
        F.size(MEMBERS).cast("long").alias("source_organism_record_count"),
        F.size("source_labels").cast("long").alias("source_label_count"),
        F.size("standardized_identities").cast("long").alias("standardized_identity_count"),
        *sets,
        *statuses,
        *[tri_state(r.status).alias(r.flag) for r in RULES],
        *designations,
        *MARKER_RESULTS,
    )


MARKER_RESULTS = ("any_susceptible_marker", "any_other_marker")


def marker_results(members: Column) -> list[Column]:
    """What the second reconciliation would say of the markers of a record, from the flags of its members.

    A marker is susceptible if some member is and none is anything else; a missing one beside it is tolerated.
    """
    agreed, other = [], []
    for drug in MARKER_DRUGS:
        tested, susceptible, differs = (
            F.array_max(members[f"{drug.lower()}_{flag}"]) for flag in ("tested", "susceptible", "other")
        )
        agreed.append(susceptible & ~differs)
        other.append(tested & ~(susceptible & ~differs))
    either = (reduce(lambda a, b: a | b, flags) for flags in (agreed, other))
    return [flag.alias(name) for flag, name in zip(either, MARKER_RESULTS)]


def flatten_union(arrays: str, name: str):
    """Aggregate: the sorted union of the arrays of a group."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(arrays)))).alias(name)


def culture_observations(
    records: DataFrame,
    window: ReportWindow,
    statuses: Sequence[str] = STATUS_COLUMNS,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """One row per culture and group inside the window, across phenotypes.

    A culture has at most one record per phenotype, which bounds the lists that are flattened.
    """
    keys = ("source_version", "cohort_id", "patient_key", "organism_reporting_group", "culture_key")
    rolled = (
        records.filter(window.usable("culture_time_shifted"))
        .groupBy(*extra_keys, *keys)
        .agg(
            F.min("culture_time_shifted").alias("culture_time_shifted"),
            flatten_union(MEMBERS, MEMBERS),
            F.array_sort(F.collect_set("reporting_phenotype")).alias("source_reporting_phenotypes"),
            # One record per phenotype, so rows are distinct records.
            n_rows().alias("phenotype_records_on_culture"),
            *[strongest_status(s).alias(s) for s in statuses],
        )
    )
    key = surrogate_key("source_version", "cohort_id", "culture_key", "organism_reporting_group")
    return rolled.select(key.alias("reporting_culture_observation_key"), "*")
