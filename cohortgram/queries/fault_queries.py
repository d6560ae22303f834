"""Checks that pass on a sound report, run on tables with injected faults: what they count comes from the data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.operators import audits, checks, compare
from cohortgram.operators.rollup import repeated_rows
from cohortgram.plans import quality
from cohortgram.queries.check_queries import _QUALITY, _RECORDS, _quality_sql
from cohortgram.queries.context import Context
from cohortgram.queries.registry import QUERIES, query
from cohortgram.queries.sql import any_rows

_CHECKS = (
    "first_record",
    "forbidden_categories",
    "unapproved_or_excluded",
    "overall_denominator",
    "grid_completeness",
    "window_bounds",
    "scoped_rules",
    "denominators",
)


def _counted_sql(name: str) -> str:
    of = QUERIES[f"check_{name}"]
    columns = ", ".join(c.lstrip("@#$") for c in of.columns.split())
    return f"SELECT '{name}' AS check_name, count(*) AS failing_rows FROM ({of.sql.replace('{columns}', columns)}) {name}"


@query(
    "check_name failing_rows",
    "\nUNION ALL ".join(_counted_sql(name) for name in _CHECKS),
    *dict.fromkeys(need for name in _CHECKS for need in QUERIES[f"check_{name}"].needs),
)
def report_checks_faults(c: Context):
    """Every report check on the faulty tables of its own query."""
    return checks.summary({name: QUERIES[f"check_{name}"].build(c) for name in _CHECKS})


def _with_faults(frame: DataFrame, faults: dict[str, tuple[str, str]]) -> DataFrame:
    """``faults``: the column, where, and what it becomes there."""
    changed = {column: F.expr(f"CASE WHEN {where} THEN {value} ELSE {column} END") for column, (where, value) in faults.items()}
    return frame.withColumns(changed)


def _with_faults_sql(table: str, faults: dict[str, tuple[str, str]]) -> str:
    changed = ", ".join(f"CASE WHEN {where} THEN {value} ELSE {column} END AS {column}" for column, (where, value) in faults.items())
    return f"(SELECT * REPLACE ({changed}) FROM {table})"


_MART_FAULTS = {
    "untested_count": ("antibiotic = 'Linezolid'", "-1"),
    "resistant_count": ("antibiotic = 'Gentamicin'", "categorized_count + 1"),
    "intermediate_count": ("antibiotic = 'Meropenem'", "categorized_count + 2"),
    "gram_stain_group": ("cohort_id = 'blood'", "NULL"),
    "susceptibility_mart_key": ("antibiotic = 'Ampicillin'", "'one key'"),
}
_PARTS = "categorized_count + inconclusive_count + synergism_count + missing_result_count + conflict_result_count"


@query(
    "mart_rows unique_keys missing_gram_group negative_count_rows denominator_mismatches tested_mismatches "
    "status_mismatches category_mismatches bound_violations",
    f"""SELECT count(*) AS mart_rows, count(DISTINCT susceptibility_mart_key) AS unique_keys,
  {any_rows('gram_stain_group IS NULL')} AS missing_gram_group,
  {any_rows('least(eligible_count, categorized_count, untested_count) < 0')} AS negative_count_rows,
  {any_rows(f'eligible_count <> {_PARTS} + untested_count')} AS denominator_mismatches,
  {any_rows('tested_endpoint_count + untested_count <> eligible_count')} AS tested_mismatches,
  {any_rows(f'tested_endpoint_count <> {_PARTS}')} AS status_mismatches,
  {any_rows('categorized_count <> susceptible_count + resistant_count + intermediate_count')} AS category_mismatches,
  {any_rows('categorized_count > eligible_count OR '
            'greatest(susceptible_count, resistant_count, intermediate_count) > categorized_count')} AS bound_violations
FROM {_with_faults_sql("mart", _MART_FAULTS)}""",
    "mart",
)
def mart_structure_faults(c: Context):
    return audits.mart_structure(_with_faults(c.full.susceptibility, _MART_FAULTS))


_MDRO_FAULTS = {
    "positive_count": ("cohort_id = 'blood'", "-1"),
    "not_detected_count": ("cohort_id = 'urine'", "-1"),
    "not_evaluable_count": ("organism_base_name = 'Escherichia coli'", "-2"),
    "phenotype_pct": ("cohort_id = 'respiratory'", "150.0"),
    "gram_stain_group": ("organism_base_name = 'Pseudomonas aeruginosa'", "NULL"),
    "mdro_mart_key": ("cohort_id = 'blood'", "'one key'"),
}


@query(
    "mart_rows unique_keys count_identity_mismatches invalid_counts percentage_formula_mismatches "
    "out_of_bounds_percentages missing_gram_classification",
    f"""SELECT count(*) AS mart_rows, count(DISTINCT mdro_mart_key) AS unique_keys,
  {any_rows('denominator_count <> positive_count + not_detected_count + not_evaluable_count '
            'OR evaluable_count <> positive_count + not_detected_count')} AS count_identity_mismatches,
  {any_rows('least(positive_count, not_detected_count, not_evaluable_count) < 0 '
            'OR positive_count > denominator_count')} AS invalid_counts,
  {any_rows('phenotype_pct IS DISTINCT FROM round(100.0 * positive_count / nullif(denominator_count, 0), 1) '
            'OR evaluable_pct IS DISTINCT FROM round(100.0 * evaluable_count / nullif(denominator_count, 0), 1)')}
    AS percentage_formula_mismatches,
  {any_rows('phenotype_pct NOT BETWEEN 0 AND 100 OR evaluable_pct NOT BETWEEN 0 AND 100')} AS out_of_bounds_percentages,
  {any_rows('gram_stain_group IS NULL')} AS missing_gram_classification
FROM {_with_faults_sql("mdro", _MDRO_FAULTS)}""",
    "mdro",
)
def mdro_structure_faults(c: Context):
    return audits.mdro_structure(_with_faults(c.full.mdro, _MDRO_FAULTS))


@query(
    "compared_groups selection_mismatches",
    f"""SELECT count(*) AS compared_groups, {any_rows("cohort_id = 'blood' OR right(patient_key, 1) = '3'")} AS
  selection_mismatches FROM first_overall""",
    "first_overall",
)
def overall_rebuild_faults(c: Context):
    """One cohort is missing from the selection, and some patients have another culture."""
    other = F.when(F.right("patient_key", F.lit(1)) == "3", "another").otherwise(F.col("culture_key"))
    selected = c.full.first_overall.filter("cohort_id <> 'blood'").withColumn("culture_key", other)
    return audits.overall_rebuild(c.full.overall_observations, selected)


@query(
    "selected_cultures_compared source_key_array_mismatches phenotype_record_count_mismatches",
    f"""SELECT count(*) AS selected_cultures_compared, {any_rows("cohort_id = 'urine'")} AS source_key_array_mismatches,
  {any_rows("cohort_id = 'blood'")} AS phenotype_record_count_mismatches FROM first_overall""",
    "first_overall",
)
def member_rebuild_faults(c: Context):
    """One cohort's member arrays have a stranger, another's record counts are one too high."""
    stranger = F.array_sort(F.array_append("source_culture_organism_keys", F.lit("stranger")))
    members = F.when(F.col("cohort_id") == "urine", stranger).otherwise(F.col("source_culture_organism_keys"))
    more = F.col("phenotype_records_on_culture") + (F.col("cohort_id") == "blood").cast("int")
    selected = c.full.first_overall.withColumns(
        {"source_culture_organism_keys": members, "phenotype_records_on_culture": more}
    )
    return audits.member_rebuild(selected, c.full.records)


@query(
    "culture_organism_key antibiotic row_count",
    "SELECT culture_organism_key, antibiotic, 2::bigint AS row_count FROM endpoint WHERE resolution_status = 'conflict'",
    "endpoint",
)
def duplicate_endpoints_faults(c: Context):
    """Conflicting endpoints stand twice in the table."""
    twice = c.full.endpoints.unionByName(c.full.endpoints.filter("resolution_status = 'conflict'"))
    return repeated_rows(twice, ["culture_organism_key", "antibiotic"])


@query(
    _QUALITY,
    _quality_sql(
        _RECORDS,
        {
            ("records", "cohort_id is accepted"): "SELECT count(*) FROM record WHERE right(patient_key, 1) = '7'",
            ("records", "organism_name is not null"): "SELECT count(*) FROM record WHERE reporting_phenotype = 'esce_r'",
            ("records", "reporting_culture_organism_key is unique"): "SELECT count(*) FROM record WHERE cohort_id = 'blood' "
            "AND right(patient_key, 1) <> '7'",
        },
    ),
    "record",
)
def quality_of_records_faults(c: Context):
    """Records with an unknown cohort, records without a name, and one cohort's records twice."""
    records = c.full.records.withColumns(
        {
            "cohort_id": F.when(F.right("patient_key", F.lit(1)) == "7", "ward").otherwise(F.col("cohort_id")),
            "organism_name": F.when(F.col("reporting_phenotype") != "esce_r", F.col("organism_name")),
        }
    )
    again = records.filter("cohort_id = 'blood'").withColumn("organism_name", F.coalesce("organism_name", F.lit("again")))
    return quality.quality_report(c.full, {"records": records.unionByName(again)}, _RECORDS)


@query(
    "culture_organism_key antibiotic resolution_status left_rows right_rows",
    """SELECT culture_organism_key, antibiotic, unnest(['conflict', 'missing']) AS resolution_status,
  unnest([1, 0])::bigint AS left_rows, unnest([0, 1])::bigint AS right_rows FROM endpoint WHERE resolution_status = 'conflict'""",
    "endpoint",
)
def endpoint_differences(c: Context):
    """The stored endpoints against a stored copy in which conflicts were settled as missing."""
    status = F.col("resolution_status")
    settled = c.full.endpoints.withColumn("resolution_status", F.when(status == "conflict", "missing").otherwise(status))
    copy = c.scratch.keep(f"endpoints-{uuid.uuid4().hex}", settled)
    return compare.differences(c.full.endpoints, copy, ["culture_organism_key", "antibiotic"], ["resolution_status"])


_SEEDS = ("labels", "groups", "pairs", "exclusions")
_TESTED = """SELECT DISTINCT organism_reporting_group, cohort_id, antibiotic
  FROM mapped JOIN endpoint USING (culture_organism_key)
  WHERE include_primary_summary = 1 AND mapping_status = 'reviewed'"""
_UNLISTED = f"SELECT count(*) FROM ({_TESTED}) ANTI JOIN pairs USING (organism_reporting_group, cohort_id, antibiotic)"
_UNMAPPED = "SELECT count(*) FROM (SELECT DISTINCT organism_source FROM mapped WHERE mapping_status = 'unmapped')"


@query(
    _QUALITY,
    _quality_sql(
        _SEEDS,
        {("labels", "organism_standardized is not null"): _UNMAPPED, ("labels", "mapping_status is not null"): _UNMAPPED}
        | {("pairs", f"{c} is not null"): _UNLISTED for c in ("pair_order", "include_primary_dashboard", "review_status")},
    ),
    "mapped",
    "endpoint",
    "pairs",
)
def quality_of_seeds(c: Context):
    """The promises of the reference tables, for all labels and drugs the data has as well as for all that are listed."""
    labels, pairs = c.seeds.labels, c.seeds.pairs
    found = c.full.mapped.select("organism_source").distinct()
    tested = audits.endpoint_facts(
        c.full.mapped.filter("include_primary_summary = 1 AND mapping_status = 'reviewed'"),
        c.full.endpoints,
        ["organism_reporting_group", "cohort_id"],
    )
    keys = ["organism_reporting_group", "cohort_id", "antibiotic"]
    given = {
        "labels": labels.join(found, "organism_source", "full"),
        "groups": c.seeds.groups,
        "pairs": pairs.join(tested.select(*keys).distinct(), keys, "full"),
        "exclusions": c.seeds.exclusions,
    }
    return quality.quality_report(c.full, given, _SEEDS)


@query(
    "organism_reporting_group cohort_id reporting_phenotype antibiotic exclusion_reason",
    f"""SELECT organism_reporting_group, cohort_id, reporting_phenotype, antibiotic, exclusion_reason FROM exclusions e
WHERE (cohort_id <> '*' OR reporting_phenotype <> '*') AND NOT EXISTS (
  SELECT 1 FROM active a SEMI JOIN ({_TESTED} AND antibiotic <> 'Ampicillin') t USING (organism_reporting_group, cohort_id, antibiotic)
  WHERE a.organism_reporting_group = e.organism_reporting_group AND a.antibiotic = e.antibiotic
    AND e.cohort_id IN ('*', a.cohort_id))""",
    "exclusions",
    "active",
    "mapped",
    "endpoint",
)
def check_scoped_exclusions(c: Context):
    """The scoped exclusions that touch no active pair the data has, once the data has lost one drug."""
    eligible = c.full.mapped.filter("include_primary_summary = 1 AND mapping_status = 'reviewed'")
    keys = ["organism_reporting_group", "cohort_id", "antibiotic"]
    facts = audits.endpoint_facts(eligible, c.full.endpoints, keys[:2])
    tested = facts.filter("antibiotic <> 'Ampicillin'").select(*keys).distinct()
    return checks.scoped_rules_without_pair(c.seeds.exclusions, c.seeds.pairs.join(tested, keys, "left_semi"))
