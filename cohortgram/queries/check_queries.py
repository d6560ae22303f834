"""Quality checks, on data with natural or injected faults so that there is something to find."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortgram import reference as ref
from cohortgram.operators import checks
from cohortgram.plans import quality
from cohortgram.queries.context import WINDOW, Context
from cohortgram.queries.registry import query
from cohortgram.queries.sql import WINDOW as WINDOW_SQL
from cohortgram.queries.sql import GRID_BLOCKED as BLOCKED
from cohortgram.queries.sql import literal, values

CELL = " ".join(checks.CELL_KEYS)
REPORTED = """(SELECT DISTINCT organism_reporting_group, cohort_id, reporting_phenotype, antibiotic FROM population
    JOIN (SELECT DISTINCT organism_reporting_group, antibiotic FROM pairs) USING (organism_reporting_group))"""


@query(
    "culture_key culture_description",
    "SELECT {columns} FROM culture WHERE was_positive = 1 AND culture_time_shifted IS NULL",
    "culture",
)
def check_not_null(c: Context):
    return checks.not_null(c.full.cultures, "culture_time_shifted", F.col("was_positive") == 1)


@query(
    "culture_order_key row_count",
    "SELECT culture_order_key, count(*) AS row_count FROM culture GROUP BY 1 HAVING count(*) > 1",
    "culture",
)
def check_unique(c: Context):
    return checks.unique(c.full.cultures, "culture_order_key")


@query(
    "susceptibility row_count",
    """SELECT susceptibility, count(*) AS row_count FROM staged WHERE susceptibility NOT IN
('Susceptible', 'Intermediate', 'Resistant', 'Inconclusive', 'Synergism') GROUP BY 1""",
    "staged",
)
def check_accepted_values(c: Context):
    known = (*ref.CATEGORISED, ref.INCONCLUSIVE, ref.SYNERGISM)
    return checks.accepted_values(c.full.staged, "susceptibility", known)


@query(
    "culture_organism_key organism_source",
    "SELECT {columns} FROM mapped WHERE organism_source NOT IN (SELECT organism_source FROM labels)",
    "mapped",
    "labels",
)
def check_relationships(c: Context):
    return checks.relationships(c.full.mapped, "organism_source", c.seeds.labels, "organism_source")


@query(
    "source_version patient_key encounter_key culture_order_key row_count",
    """SELECT source_version, patient_key, encounter_key, culture_order_key, count(*) AS row_count FROM ward
GROUP BY ALL HAVING count(*) > 1""",
    "ward",
)
def check_unique_combination(c: Context):
    return checks.unique_combination(
        c.ward, ["source_version", "patient_key", "encounter_key", "culture_order_key"]
    )


@query(
    "susceptibility_mart_key antibiotic eligible_count untested_count",
    """SELECT {columns} FROM mart WHERE eligible_count <> categorized_count + inconclusive_count + synergism_count
+ missing_result_count + conflict_result_count + untested_count""",
    "mart",
)
def check_expression(c: Context):
    """The count identity. Results that are kept as unknown text break it, as they should."""
    return checks.expression_is_true(c.full.susceptibility, checks.COUNT_IDENTITY)


@query(
    "check_name failing_rows",
    """SELECT 'culture_time_shifted is not null' AS check_name, count(*) - count(culture_time_shifted) AS failing_rows
  FROM culture
UNION ALL SELECT 'ordering_mode is not null', count(*) - count(ordering_mode) FROM culture
UNION ALL SELECT 'culture_description is accepted',
  count(*) FILTER (WHERE culture_description NOT IN ('BLOOD', 'URINE', 'RESPIRATORY')) FROM culture
UNION ALL SELECT 'positive rows are consistent', count(*) FILTER (WHERE coalesce(has_order_level_conflict, true))
  FROM culture""",
    "culture",
)
def row_checks(c: Context):
    """Several row-level checks in one scan."""
    return checks.row_checks(
        c.full.cultures,
        checks.not_null_checks(["culture_time_shifted", "ordering_mode"])
        | checks.accepted_checks({"culture_description": list(ref.COHORT_OF_DESCRIPTION)})
        | {"positive rows are consistent": ~F.col("has_order_level_conflict")},
    )


@query(
    f"{CELL} patient_key expected_key actual_key",
    """SELECT source_version, cohort_id, organism_reporting_group, reporting_phenotype, patient_key,
  reporting_culture_organism_key AS expected_key, cast(NULL AS varchar) AS actual_key FROM first_stratified
WHERE reporting_phenotype = 'esce_r'""",
    "first_stratified",
)
def check_first_record(c: Context):
    """A selection that lost one category: the rebuild names every patient of it."""
    kept = c.full.first_stratified.filter(F.col("reporting_phenotype") != "esce_r")
    return checks.first_record_rebuild(c.full.candidates, kept)


@query(
    f"{CELL} patient_key expected_key actual_key",
    """SELECT source_version, cohort_id, organism_reporting_group, reporting_phenotype, patient_key,
  reporting_culture_organism_key AS expected_key, cast(NULL AS varchar) AS actual_key FROM first_stratified
WHERE reporting_phenotype = 'esce_r'""",
    "first_stratified",
)
def check_first_record_by_fingerprint(c: Context):
    """The same fault found in a stored selection, by rows only where row hashes add up to something else."""
    kept = c.full.first_stratified.filter(F.col("reporting_phenotype") != "esce_r")
    return checks.first_record_rebuild(c.full.candidates, c.scratch.keep(f"selection-{uuid.uuid4().hex}", kept), fingerprints=True)


@query(
    f"violation {CELL} record_key",
    """SELECT 'stratified_mdro_source' AS violation, source_version, cohort_id, organism_reporting_group,
  reporting_phenotype, reporting_culture_organism_key AS record_key FROM record
  WHERE ast_cre_status = 'positive' OR ast_mdr_p_aeruginosa_status = 'positive'
UNION ALL SELECT 'mart_forbidden_category', source_version, cohort_id, organism_reporting_group, 'cre', NULL FROM mart
  WHERE reporting_phenotype = 'esce_r'
UNION ALL SELECT 'other_organism_overall', source_version, cohort_id, organism_reporting_group, 'overall', NULL
  FROM mart WHERE reporting_phenotype = 'vancomycin_resistant'""",
    "record",
    "mart",
)
def check_forbidden_categories(c: Context):
    """A table with wrong categories and a selection that did not leave resistant records out."""
    wrong = F.when(F.col("reporting_phenotype") == "esce_r", "cre").when(
        F.col("reporting_phenotype") == "vancomycin_resistant", "overall"
    )
    mart = c.full.susceptibility.withColumn("reporting_phenotype", F.coalesce(wrong, "reporting_phenotype"))
    return checks.forbidden_categories(mart, c.full.records)


@query(
    "organism_reporting_group cohort_id reporting_phenotype antibiotic failing_rule",
    f"""SELECT *, 'not_approved' AS failing_rule FROM {REPORTED} g
  ANTI JOIN active USING (organism_reporting_group, cohort_id, antibiotic)
UNION ALL SELECT *, 'explicitly_excluded' FROM {REPORTED} g WHERE {BLOCKED}""",
    "population",
    "pairs",
    "active",
    "exclusions",
)
def check_unapproved_or_excluded(c: Context):
    """A grid that took every listed drug of a group for every cohort."""
    listed = c.seeds.pairs.select("organism_reporting_group", "antibiotic").distinct()
    grid = c.full.population.join(listed, "organism_reporting_group")
    return checks.unapproved_or_excluded(grid, c.seeds.pairs, c.seeds.exclusions)


@query(
    "source_version cohort_id organism_reporting_group antibiotic eligible_count expected_eligible_count",
    """SELECT source_version, cohort_id, organism_reporting_group, antibiotic, eligible_count + 1 AS eligible_count,
  eligible_count AS expected_eligible_count
FROM mart WHERE reporting_phenotype = 'overall' AND antibiotic = 'Linezolid'""",
    "mart",
)
def check_overall_denominator(c: Context):
    changed = F.col("eligible_count") + F.when(F.col("antibiotic") == "Linezolid", 1).otherwise(0)
    return checks.overall_denominator(
        c.full.susceptibility.withColumn("eligible_count", changed), c.full.first_overall
    )


@query(
    f"{CELL} antibiotic expected_eligible_count $eligible_count",
    """SELECT source_version, cohort_id, organism_reporting_group, reporting_phenotype, antibiotic,
  eligible_count AS expected_eligible_count, CASE antibiotic WHEN 'Meropenem' THEN cast(eligible_count + 1 AS varchar) END
  AS eligible_count FROM mart WHERE antibiotic IN ('Gentamicin', 'Meropenem')""",
    "mart",
)
def check_grid_completeness(c: Context):
    """A table that lost one drug and has a wrong denominator for another."""
    t = c.full
    expected = checks.expected_cells(t.first_overall, t.first_stratified, c.seeds.pairs, c.seeds.exclusions)
    changed = F.col("eligible_count") + F.when(F.col("antibiotic") == "Meropenem", 1).otherwise(0)
    actual = t.susceptibility.filter(F.col("antibiotic") != "Gentamicin").withColumn("eligible_count", changed)
    return checks.grid_completeness(actual, expected)


@query(
    "@culture_time_shifted",
    f"""SELECT {{columns}} FROM (SELECT culture_time_shifted FROM first_overall
  UNION ALL SELECT culture_time_shifted FROM first_stratified) WHERE NOT ({WINDOW_SQL})""",
    "first_overall",
    "first_stratified",
)
def check_window_bounds(c: Context):
    """Full-release selections held against the window."""
    return checks.window_bounds([c.full.first_overall, c.full.first_stratified], WINDOW)


@query(
    "organism_reporting_group cohort_id reporting_phenotype antibiotic",
    f"""SELECT DISTINCT organism_reporting_group, cohort_id, reporting_phenotype, antibiotic FROM (
  SELECT organism_reporting_group, cohort_id, reporting_phenotype, antibiotic
  FROM population_endpoint JOIN population USING (selected_reporting_isolate_key, reporting_phenotype))
ANTI JOIN active USING (organism_reporting_group, cohort_id, antibiotic)""",
    "population",
    "population_endpoint",
    "active",
)
def check_scoped_rules(c: Context):
    """Rules written for every tested drug of a category: those without an active pair."""
    key = "selected_reporting_isolate_key"
    tested = c.full.population_endpoints.join(c.full.population, [key, "reporting_phenotype"])
    rules = tested.select("organism_reporting_group", "cohort_id", "reporting_phenotype", "antibiotic").distinct()
    return checks.scoped_rules_without_pair(rules, c.seeds.pairs)


@query(
    f"{CELL} antibiotic eligible_count $unique_patients",
    """SELECT m.source_version, m.cohort_id, m.organism_reporting_group, reporting_phenotype, antibiotic,
  eligible_count, cast(unique_patients AS varchar) AS unique_patients
FROM mart m LEFT JOIN (SELECT source_version, cohort_id, organism_reporting_group,
    count(DISTINCT patient_key) AS unique_patients FROM observation
  WHERE culture_time_shifted < TIMESTAMP '1997-01-01' GROUP BY ALL) p
  USING (source_version, cohort_id, organism_reporting_group)
WHERE reporting_phenotype <> 'overall' AND (unique_patients IS NULL OR eligible_count > unique_patients)""",
    "mart",
    "observation",
)
def check_denominators(c: Context):
    """The full table held against patients of the first two years only."""
    early = c.full.observations.filter(F.col("culture_time_shifted") < F.lit("1997-01-01").cast("timestamp"))
    return checks.denominators_within_population(c.full.susceptibility, early)


@query(
    "check_name failing_rows",
    """SELECT check_name, 0::bigint AS failing_rows FROM (VALUES ('first_record'), ('forbidden_categories'),
('unapproved_or_excluded'), ('overall_denominator'), ('grid_completeness'), ('window_bounds'), ('scoped_rules'),
('denominators')) AS t(check_name)""",
)
def report_checks(c: Context):
    """Every report check on the windowed report as built."""
    t, s = c.windowed, c.seeds
    expected = checks.expected_cells(t.first_overall, t.first_stratified, s.pairs, s.exclusions)
    results = {
        "first_record": checks.first_record_rebuild(t.candidates, t.first_stratified),
        "forbidden_categories": checks.forbidden_categories(t.susceptibility, t.first_stratified),
        "unapproved_or_excluded": checks.unapproved_or_excluded(t.susceptibility, s.pairs, s.exclusions),
        "overall_denominator": checks.overall_denominator(t.susceptibility, t.first_overall),
        "grid_completeness": checks.grid_completeness(t.susceptibility, expected),
        "window_bounds": checks.window_bounds([t.first_overall, t.first_stratified], t.window),
        "scoped_rules": checks.scoped_rules_without_pair(s.exclusions, s.pairs),
        "denominators": checks.denominators_within_population(t.susceptibility, t.observations),
    }
    return checks.summary(results)




_FACTS = ("staged", "demographics", "ward", "cultures", "culture_organisms", "resolved", "organisms", "endpoints")
_RECORDS = ("cohort_records", "mapped", "phenotypes", "records", "observations", "group_endpoints", "candidates")
_REPORTS = (
    "first_stratified",
    "first_stratified_endpoints",
    "first_overall",
    "first_overall_endpoints",
    "susceptibility",
    "mdro",
)


def _quality_sql(relations: tuple[str, ...], faults: dict[tuple[str, str], str]) -> str:
    """Every check of the relations with zero failing rows, but for the faults the data has, which are counted."""
    rows = [(r, name) for r in relations for name in quality.check_names(r)]
    counted = " ".join(
        f"WHEN relation = '{r}' AND check_name = {literal(name)} THEN ({sql})" for (r, name), sql in faults.items()
    )
    failing = f"CASE {counted} ELSE 0 END" if counted else "0"
    return f"SELECT relation, check_name, cast({failing} AS bigint) AS failing_rows FROM ({values('relation, check_name', rows)})"


_QUALITY = "relation check_name failing_rows"
_ORDER_UNIQUE = "patient_key, encounter_key, culture_order_key is unique"
_REPEATED = "SELECT count(*) FROM (SELECT 1 FROM {} GROUP BY patient_key, encounter_key, culture_order_key HAVING count(*) > 1)"


@query(
    _QUALITY,
    _quality_sql(
        _FACTS,
        {
            ("staged", "was_positive is not null"): "SELECT count(*) FROM staged WHERE was_positive IS NULL",
            ("demographics", _ORDER_UNIQUE): _REPEATED.format("demographics"),
            ("ward", _ORDER_UNIQUE): _REPEATED.format("ward"),
            ("resolved", "susceptibility is accepted"): "SELECT count(*) FROM endpoint WHERE resolution_status = 'resolved' "
            "AND susceptibility = 'Null'",
        },
    ),
    "staged",
    "demographics",
    "ward",
    "endpoint",
)
def quality_of_facts(c: Context):
    """Declared checks of staging and facts. Two releases repeat orders, and padded sentinels stay as text."""
    return quality.quality_report(c.full, {"demographics": c.demographics, "ward": c.ward}, _FACTS)


@query(_QUALITY, _quality_sql(_RECORDS, {}))
def quality_of_records(c: Context):
    return quality.quality_report(c.full, relations=_RECORDS)


@query(
    _QUALITY,
    _quality_sql(
        _REPORTS,
        {
            ("susceptibility", checks.COUNT_IDENTITY): "SELECT count(*) FROM mart WHERE tested_endpoint_count <> "
            "categorized_count + inconclusive_count + synergism_count + missing_result_count + conflict_result_count"
        },
    ),
    "mart",
)
def quality_of_reports(c: Context):
    return quality.quality_report(c.full, relations=_REPORTS)
