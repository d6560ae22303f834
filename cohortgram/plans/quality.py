"""What every relation of a report promises, and one report of what it does not keep."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram import reference as ref
from cohortgram.functions.keys import packed
from cohortgram.functions.measures import n_rows
from cohortgram.operators import checks, profile
from cohortgram.plans.report import CULTURE, ReportTables

FLAG = (0, 1)
ORDER = ("patient_key", "encounter_key", "culture_order_key")
STATUS = ("positive", "not_detected", "not_evaluable", "not_applicable")
RESOLUTION = ("resolved", "missing", "conflict")
RESULTS = (ref.SUSCEPTIBLE, ref.RESISTANT, ref.INTERMEDIATE, ref.INCONCLUSIVE, ref.SYNERGISM)
GRAM = ("gram_positive", "gram_negative")
MDRO = tuple(label for _, label in ref.MDRO_LABELS)
RECORD_PHENOTYPES = tuple(p for p in ref.PHENOTYPES if p not in ("overall", "oxacillin_susceptible"))
ROWS = "rows"
HAS_MEMBERS = "size(source_culture_organism_keys) > 0"


@dataclass(frozen=True)
class Contract:
    """Declared checks of one relation."""

    required: tuple[str, ...] = ()
    required_where: dict[str, str] = field(default_factory=dict)
    accepted: dict[str, tuple] = field(default_factory=dict)
    expressions: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


# The promises, by relation name.
CONTRACTS: dict[str, Contract] = {
    "staged": Contract(
        required=(*ORDER, "was_positive", "source_version"),
        accepted={"was_positive": FLAG},
    ),
    "demographics": Contract(required=ORDER, unique=(ORDER,)),
    "ward": Contract(
        required=ORDER,
        accepted={f"hosp_ward_{w}": FLAG for w in ("ip", "op", "er", "icu")},
        unique=(ORDER,),
    ),
    "cultures": Contract(
        required=("culture_key", "source_version", *ORDER),
        accepted={"was_positive": FLAG},
        unique=(("culture_key",),),
    ),
    "culture_organisms": Contract(
        required=("culture_organism_key", "culture_key", "organism", "source_version"),
        unique=(("culture_organism_key",), ("culture_key", "organism")),
        references={"culture_key": ("cultures", "culture_key")},
    ),
    "resolved": Contract(
        required=("susceptibility_key", "culture_organism_key", "antibiotic", "susceptibility"),
        accepted={"susceptibility": RESULTS},
        unique=(("susceptibility_key",), ("culture_organism_key", "antibiotic")),
        references={"culture_organism_key": ("culture_organisms", "culture_organism_key")},
    ),
    "organisms": Contract(
        required=(
            "organism_source_key",
            "organism_source",
            "include_primary_summary",
            "mapping_status",
            "has_reviewed_mapping",
        ),
        required_where={
            "organism_standardized": "mapping_status = 'reviewed'",
            "organism_reporting_group": "mapping_status = 'reviewed'",
        },
        accepted={"include_primary_summary": FLAG, "mapping_status": ("reviewed", "unmapped")},
        unique=(("organism_source_key",), ("organism_source",)),
    ),
    "endpoints": Contract(
        required=("culture_organism_key", "antibiotic", "resolution_status"),
        accepted={"resolution_status": RESOLUTION},
        unique=(("culture_organism_key", "antibiotic"),),
    ),
    "cohort_records": Contract(
        required=("culture_organism_key", "culture_key", "patient_key", "organism", "cohort_id"),
        accepted={"cohort_id": ref.COHORTS},
        unique=(("culture_organism_key", "cohort_id"),),
    ),
    "mapped": Contract(
        required=("culture_organism_key", "organism_source_key", "organism_source", "cohort_id", "mapping_status"),
        unique=(("culture_organism_key", "cohort_id"),),
        references={"organism_source_key": ("organisms", "organism_source_key")},
    ),
    "phenotypes": Contract(
        required=("culture_organism_key", "cohort_id", *ref.STATUS_COLUMNS),
        accepted={"cohort_id": ref.COHORTS, **{s: STATUS for s in ref.STATUS_COLUMNS}},
        unique=(("culture_organism_key",),),
        references={"culture_organism_key": ("mapped", "culture_organism_key")},
    ),
    "records": Contract(
        required=(
            "reporting_culture_organism_key",
            "culture_key",
            "patient_key",
            "cohort_id",
            "organism_reporting_group",
            "organism_name",
            "reporting_phenotype",
            "source_organism_record_count",
        ),
        accepted={
            "cohort_id": ref.COHORTS,
            "reporting_phenotype": (*RECORD_PHENOTYPES, *ref.INTERNAL_PHENOTYPES),
        },
        unique=(("reporting_culture_organism_key",),),
    ),
    "observations": Contract(
        required=("reporting_culture_observation_key", "culture_time_shifted", "source_culture_organism_keys"),
        expressions=(HAS_MEMBERS,),
        unique=(
            ("reporting_culture_observation_key",),
            ("source_version", "cohort_id", "culture_key", "organism_reporting_group"),
        ),
    ),
    "group_endpoints": Contract(
        required=(
            "reporting_culture_susceptibility_key",
            "ast_scope",
            "reporting_source_key",
            "antibiotic",
            "resolution_status",
        ),
        accepted={"ast_scope": ("overall", "stratified"), "resolution_status": RESOLUTION},
        unique=(
            ("reporting_culture_susceptibility_key",),
            ("ast_scope", "reporting_source_key", "antibiotic"),
        ),
    ),
    "candidates": Contract(
        required=("reporting_culture_organism_key", "reporting_phenotype"),
        accepted={"reporting_phenotype": tuple(p for p in ref.PHENOTYPES if p != "overall")},
        unique=(("reporting_culture_organism_key", "reporting_phenotype"),),
    ),
    "first_stratified": Contract(
        required=(
            "first_stratified_reporting_culture_key",
            "reporting_culture_organism_key",
            "reporting_phenotype",
            "culture_time_shifted",
        ),
        unique=(
            ("first_stratified_reporting_culture_key",),
            ("source_version", "cohort_id", "patient_key", "organism_reporting_group", "reporting_phenotype"),
        ),
        references={"reporting_culture_organism_key": ("records", "reporting_culture_organism_key")},
    ),
    "first_stratified_endpoints": Contract(
        required=(
            "first_stratified_reporting_susceptibility_key",
            "first_stratified_reporting_culture_key",
            "antibiotic",
            "resolution_status",
        ),
        accepted={"resolution_status": RESOLUTION},
        unique=(
            ("first_stratified_reporting_susceptibility_key",),
            ("first_stratified_reporting_culture_key", "antibiotic"),
        ),
        references={
            "first_stratified_reporting_culture_key": ("first_stratified", "first_stratified_reporting_culture_key")
        },
    ),
    "first_overall": Contract(
        required=(
            "overall_reporting_isolate_key",
            "culture_key",
            "reporting_culture_observation_key",
            "culture_time_shifted",
            "organism_reporting_group",
            "source_culture_organism_keys",
            "ast_cre_status",
            "ast_esce_enterobacterales_status",
            "ast_oxacillin_resistance_status",
            "ast_vancomycin_resistance_status",
        ),
        expressions=(HAS_MEMBERS,),
        unique=(
            ("overall_reporting_isolate_key",),
            ("source_version", "cohort_id", "patient_key", "organism_reporting_group"),
        ),
        references={"reporting_culture_observation_key": ("observations", "reporting_culture_observation_key")},
    ),
    "first_overall_endpoints": Contract(
        required=(
            "overall_reporting_susceptibility_key",
            "overall_reporting_isolate_key",
            "antibiotic",
            "resolution_status",
        ),
        accepted={"resolution_status": RESOLUTION},
        unique=(("overall_reporting_susceptibility_key",), ("overall_reporting_isolate_key", "antibiotic")),
        references={"overall_reporting_isolate_key": ("first_overall", "overall_reporting_isolate_key")},
    ),
    "susceptibility": Contract(
        required=(
            "susceptibility_mart_key",
            "source_version",
            "cohort_id",
            "organism_reporting_group",
            "organism_name",
            "reporting_phenotype",
            "antibiotic",
            "eligible_count",
            "tested_endpoint_count",
            "categorized_count",
            "susceptible_count",
            "resistant_count",
            "intermediate_count",
            "inconclusive_count",
            "synergism_count",
            "missing_result_count",
            "conflict_result_count",
            "untested_count",
            "display_status",
            "gram_stain_group",
        ),
        accepted={
            "cohort_id": ref.COHORTS,
            "reporting_phenotype": ref.PHENOTYPES,
            "display_status": ("display", "insufficient_data"),
            "gram_stain_group": GRAM,
        },
        expressions=(checks.COUNT_IDENTITY,),
        unique=(("susceptibility_mart_key",),),
    ),
    "mdro": Contract(
        required=(
            "mdro_mart_key",
            "source_version",
            "cohort_id",
            "organism_base_name",
            "mdro_phenotype",
            "denominator_count",
            "positive_count",
            "not_detected_count",
            "not_evaluable_count",
            "evaluable_count",
            "phenotype_pct",
            "evaluable_pct",
            "gram_stain_group",
        ),
        accepted={"cohort_id": ref.COHORTS, "mdro_phenotype": MDRO, "gram_stain_group": GRAM},
        expressions=checks.MDRO_IDENTITIES,
        unique=(("mdro_mart_key",),),
    ),
    "labels": Contract(
        required=("organism_source", "organism_standardized", "mapping_status"),
        accepted={"include_primary_summary": FLAG},
        unique=(("organism_source",),),
    ),
    "groups": Contract(
        required=ref.GROUP_COLUMNS, accepted={"gram_stain_group": GRAM}, unique=(("organism_reporting_group",),)
    ),
    "pairs": Contract(
        required=ref.PAIR_COLUMNS,
        accepted={
            "cohort_id": ref.COHORTS,
            "include_primary_dashboard": FLAG,
            "review_status": ("reviewed", "proposed"),
        },
        unique=(("organism_reporting_group", "cohort_id", "antibiotic"),),
    ),
    "exclusions": Contract(
        required=ref.EXCLUSION_COLUMNS[:6],
        accepted={
            "cohort_id": (ref.WILDCARD, *ref.COHORTS),
            "reporting_phenotype": (ref.WILDCARD, *ref.PHENOTYPES),
            "exclusion_reason": ref.EXCLUSION_REASONS,
        },
        unique=(("organism_reporting_group", "cohort_id", "reporting_phenotype", "antibiotic"),),
    ),
}


def row_conditions(contract: Contract) -> dict[str, Column]:
    """The checks that look at one row at a time."""
    conditional = {
        f"{c} is not null where {where}": ~F.expr(where) | F.col(c).isNotNull()
        for c, where in contract.required_where.items()
    }
    return (
        checks.not_null_checks(contract.required)
        | conditional
        | checks.accepted_checks(contract.accepted)
        | {expression: F.expr(expression) for expression in contract.expressions}
    )


def written_counts(relation: str) -> dict[str, Column]:
    """What to count while a relation is written: its rows, and the failing rows of each check that looks at one row."""
    contract = CONTRACTS.get(relation, Contract())
    return {ROWS: n_rows()} | checks.failing_counts(row_conditions(contract))


def check_names(relation: str) -> list[str]:
    """Names of a relation's checks, in the order they are reported."""
    c = CONTRACTS[relation]
    return [
        *[f"{name} is not null" for name in c.required],
        *[f"{name} is not null where {where}" for name, where in c.required_where.items()],
        *[f"{name} is accepted" for name in c.accepted],
        *c.expressions,
        *[f"{', '.join(columns)} is unique" for columns in c.unique],
        *[f"{column} is in {parent}" for column, (parent, _) in c.references.items()],
    ]


def comparable(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns alone, with surrogate keys packed, as they are only compared. Rows with the culture key lie by it and stay as they are."""
    if CULTURE in columns:
        return rows.select(*columns)
    types = dict(rows.dtypes)
    hashed = [c for c in columns if c.endswith("_key") and c not in ORDER and types[c] == "string"]
    return rows.select(*[packed(c).alias(c) if c in hashed else c for c in columns])


def relation_report(
    relation: str,
    frame: DataFrame,
    find: Callable[[str], DataFrame],
    contract: Contract | None = None,
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """Failing rows per check: one scan for all row checks, one aggregation per key, one anti join per reference.

    ``counted`` holds counts taken while the relation was written. If it has all row checks, these need no scan.
    """
    contract = contract or CONTRACTS[relation]
    conditions = row_conditions(contract)
    if counted is not None and conditions.keys() <= counted.keys():
        rows = F.array(
            *[F.struct(F.lit(n).alias("check_name"), F.lit(counted[n]).cast("long").alias("failing_rows")) for n in conditions]
        )
        parts = [frame.sparkSession.range(1).select(F.inline(rows))]
    else:
        parts = [checks.row_checks(frame, conditions)]
    keyed = {f"{', '.join(k)} is unique": checks.unique_combination(comparable(frame, k), k) for k in contract.unique}
    related = {
        f"{column} is in {parent}": checks.relationships(
            comparable(frame, (column,)), column, comparable(find(parent), (parent_column,)), parent_column
        )
        for column, (parent, parent_column) in contract.references.items()
    }
    for name, failing in (keyed | related).items():
        parts.append(
            failing.agg(n_rows().alias("failing_rows")).select(F.lit(name).alias("check_name"), "failing_rows")
        )
    return reduce(DataFrame.unionByName, parts).select(F.lit(relation).alias("relation"), "check_name", "failing_rows")


def quality_report(
    tables: ReportTables, more: dict[str, DataFrame] | None = None, relations: tuple[str, ...] | None = None
) -> DataFrame:
    """Every declared check of a report. ``more`` holds relations that are not part of the tables.

    Row checks of relations that were counted while they were written (``ReportTables(counts=written_counts)``) scan nothing.
    """
    given = dict(more or {})

    def find(name: str) -> DataFrame:
        if name in given:
            return given[name]
        return getattr(tables.seeds if hasattr(tables.seeds, name) else tables, name)

    names = relations or tuple(n for n in CONTRACTS if n in given or hasattr(tables.seeds, n) or hasattr(type(tables), n))
    frames = {n: find(n) for n in names}
    counted = {n: tables.counted.get(n) for n in names if n not in given}
    return reduce(DataFrame.unionByName, [relation_report(n, frames[n], find, counted=counted.get(n)) for n in names])


def layer_counts(layers: Mapping[str, DataFrame], counted: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``model_name, row_count`` per layer: as counted while it was written, or else by a scan."""
    known = {name: counted[name][ROWS] for name in layers if ROWS in counted.get(name, {})}
    return profile.layer_counts(layers, known)
