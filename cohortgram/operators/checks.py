"""Quality checks. Each returns the failing rows: an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.measures import n_rows
from cohortgram.functions.windows import ReportWindow
from cohortgram.operators import compare
from cohortgram.operators.marts import active_pairs, wildcard_cover
from cohortgram.operators.select import CATEGORY_KEYS, RECORD_KEY
from cohortgram.reference import INTERNAL_PHENOTYPES, OVERALL_GROUPS, WILDCARD

CELL_KEYS = ("source_version", "cohort_id", "organism_reporting_group", "reporting_phenotype")
DRUG_KEYS = ("organism_reporting_group", "cohort_id", "reporting_phenotype", "antibiotic")


# -- declarative column checks ---------------------------------------------------------------------
def not_null(rows: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    return (rows if where is None else rows.filter(where)).filter(F.col(column).isNull())


def unique(rows: DataFrame, column: str) -> DataFrame:
    return unique_combination(rows.filter(F.col(column).isNotNull()), [column])


def unique_combination(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(n_rows().alias("row_count")).filter("row_count > 1")


def accepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values off the list with their row counts; NULL passes."""
    return (
        rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(column)
        .agg(n_rows().alias("row_count"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent; NULL keys pass."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def expression_is_true(rows: DataFrame, expression: str | Column) -> DataFrame:
    """Rows where the expression is false or NULL."""
    condition = F.expr(expression) if isinstance(expression, str) else expression
    return rows.filter(~F.coalesce(condition, F.lit(False)))


def failing_counts(checks: dict[str, Column]) -> dict[str, Column]:
    """The number of rows for which each condition is false or NULL, as aggregates."""
    return {name: F.count_if(~F.coalesce(c, F.lit(False))) for name, c in checks.items()}


def row_checks(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Failing-row counts of many row-level conditions in one scan, as (check_name, failing_rows)."""
    counted = rows.agg(*[count.alias(name) for name, count in failing_counts(checks).items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("failing_rows")) for n in checks])
    return counted.select(F.inline(pairs))


def not_null_checks(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c} is not null": F.col(c).isNotNull() for c in columns}


def accepted_checks(lists: dict[str, Sequence]) -> dict[str, Column]:
    return {f"{c} is accepted": F.col(c).isNull() | F.col(c).isin(*values) for c, values in lists.items()}


# -- checks of a finished report -------------------------------------------------------------------
def _both_sides(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(actual, list(keys), "full")


def first_record_rebuild(candidates: DataFrame, selected: DataFrame, fingerprints: bool = False) -> DataFrame:
    """Selections that differ from an independent rebuild: smallest (time, culture, record) per category.

    ``fingerprints`` joins only where sums of row hashes differ (``compare.suspects``): for a stored selection and stored candidates.
    """
    order = F.struct("culture_time_shifted", "culture_key", RECORD_KEY)
    expected = candidates.groupBy(*CATEGORY_KEYS).agg(F.min(order)[RECORD_KEY].alias("key"))
    actual = selected.select(*CATEGORY_KEYS, F.col(RECORD_KEY).alias("key"))
    if fingerprints:
        expected, actual = compare.suspects(expected, actual, CATEGORY_KEYS, ["key"])
    both = _both_sides(
        expected.withColumnRenamed("key", "expected_key"), actual.withColumnRenamed("key", "actual_key"), CATEGORY_KEYS
    )
    return both.filter(~F.col("expected_key").eqNullSafe(F.col("actual_key")))


def forbidden_categories(mart: DataFrame, selected: DataFrame) -> DataFrame:
    """Categories a susceptibility table must not have, selected resistant sources, and stray overall rows."""
    no_key = F.lit(None).cast("string")

    def violation(rows: DataFrame, name: str, key: Column = no_key) -> DataFrame:
        return rows.select(F.lit(name).alias("violation"), *CELL_KEYS, key.alias("record_key"))

    resistant = (F.col("ast_cre_status") == "positive") | (F.col("ast_mdr_p_aeruginosa_status") == "positive")
    stray = (F.col("reporting_phenotype") == "overall") & ~F.col("organism_reporting_group").isin(*OVERALL_GROUPS)
    parts = [
        violation(mart.filter(F.col("reporting_phenotype").isin(*INTERNAL_PHENOTYPES)), "mart_forbidden_category"),
        violation(selected.filter(resistant), "stratified_mdro_source", F.col(RECORD_KEY)),
        violation(mart.filter(stray), "other_organism_overall"),
    ]
    return reduce(DataFrame.unionByName, parts)


def unapproved_or_excluded(mart: DataFrame, pairs: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Reported drugs that are not approved, or that an exclusion covers."""
    reported = mart.select(*DRUG_KEYS).distinct()
    approved = active_pairs(pairs).select("organism_reporting_group", "cohort_id", "antibiotic")
    missing = reported.join(approved, ["organism_reporting_group", "cohort_id", "antibiotic"], "left_anti")
    covered = wildcard_cover(reported, exclusions)
    return missing.select(*DRUG_KEYS, F.lit("not_approved").alias("failing_rule")).unionByName(
        covered.select(*DRUG_KEYS, F.lit("explicitly_excluded").alias("failing_rule"))
    )


def overall_denominator(mart: DataFrame, overall: DataFrame) -> DataFrame:
    """Overall rows whose eligible count is not the number of patients selected."""
    keys = ["source_version", "cohort_id", "organism_reporting_group"]
    expected = overall.groupBy(*keys).agg(n_rows().alias("expected_eligible_count"))
    rows = mart.filter("reporting_phenotype = 'overall'").select(*keys, "antibiotic", "eligible_count")
    return rows.join(expected, keys, "left").filter(
        ~F.col("eligible_count").eqNullSafe(F.col("expected_eligible_count"))
    )


def expected_cells(
    overall: DataFrame, stratified: DataFrame, pairs: DataFrame, exclusions: DataFrame
) -> DataFrame:
    """The cells a table must have, built without the operators that build the table.

    Rules are expanded to plain cells by their wildcards and taken out by an equality anti join.
    """
    population = overall.select(
        "source_version", "cohort_id", "organism_reporting_group", F.lit("overall").alias("reporting_phenotype")
    ).unionByName(stratified.select(*CELL_KEYS))
    counts = population.groupBy(*CELL_KEYS).agg(n_rows().alias("expected_eligible_count"))
    allowed = pairs.filter("review_status = 'reviewed' and include_primary_dashboard = 1")
    grid = counts.join(
        allowed.select("cohort_id", "organism_reporting_group", "antibiotic"), ["cohort_id", "organism_reporting_group"]
    )
    spaces = grid.select(*DRUG_KEYS).distinct()
    denied = (
        spaces.join(
            exclusions.select(
                "organism_reporting_group",
                "antibiotic",
                F.nullif("cohort_id", F.lit(WILDCARD)).alias("_cohort"),
                F.nullif("reporting_phenotype", F.lit(WILDCARD)).alias("_phenotype"),
            ),
            ["organism_reporting_group", "antibiotic"],
        )
        .filter(F.coalesce("_cohort", "cohort_id") == F.col("cohort_id"))
        .filter(F.coalesce("_phenotype", "reporting_phenotype") == F.col("reporting_phenotype"))
        .select(*DRUG_KEYS)
    )
    return grid.join(denied, list(DRUG_KEYS), "left_anti")


def grid_completeness(mart: DataFrame, expected: DataFrame) -> DataFrame:
    """Cells missing from the table, cells it should not have, and wrong denominators."""
    keys = [*CELL_KEYS, "antibiotic"]
    wanted = expected.select(*keys, "expected_eligible_count")
    return _both_sides(wanted, mart.select(*keys, "eligible_count"), keys).filter(
        ~F.col("expected_eligible_count").eqNullSafe(F.col("eligible_count"))
    )


def window_bounds(selected: Sequence[DataFrame], window: ReportWindow) -> DataFrame:
    """Selected times outside the window."""
    times = reduce(DataFrame.unionByName, [s.select("culture_time_shifted") for s in selected])
    return times.filter(~window.covers("culture_time_shifted"))


def scoped_rules_without_pair(exclusions: DataFrame, pairs: DataFrame) -> DataFrame:
    """Scoped exclusions that name no active pair; broad ones may come before panel approval."""
    scoped = exclusions.filter((F.col("cohort_id") != WILDCARD) | (F.col("reporting_phenotype") != WILDCARD))
    match = (
        (F.col("rule.organism_reporting_group") == F.col("pair.organism_reporting_group"))
        & (F.col("rule.antibiotic") == F.col("pair.antibiotic"))
        & ((F.col("rule.cohort_id") == WILDCARD) | (F.col("rule.cohort_id") == F.col("pair.cohort_id")))
    )
    return scoped.alias("rule").join(active_pairs(pairs).alias("pair"), match, "left_anti")


def denominators_within_population(mart: DataFrame, observations: DataFrame) -> DataFrame:
    """Category rows with more patients than the window holds for that group."""
    keys = ["source_version", "cohort_id", "organism_reporting_group"]
    patients = observations.groupBy(*keys).agg(F.count_distinct("patient_key").alias("unique_patients"))
    rows = mart.filter("reporting_phenotype <> 'overall'").select(
        *keys, "reporting_phenotype", "antibiotic", "eligible_count"
    )
    return rows.join(patients, keys, "left").filter(
        F.col("unique_patients").isNull() | (F.col("eligible_count") > F.col("unique_patients"))
    )


COUNT_IDENTITY = (
    "eligible_count = categorized_count + inconclusive_count + synergism_count "
    "+ missing_result_count + conflict_result_count + untested_count"
)
MDRO_IDENTITIES = (
    "denominator_count = positive_count + not_detected_count + not_evaluable_count",
    "evaluable_count = positive_count + not_detected_count",
)


def summary(results: dict[str, DataFrame]) -> DataFrame:
    """Failing-row counts of several checks, as (check_name, failing_rows)."""
    counts = [
        rows.agg(n_rows().alias("failing_rows")).select(F.lit(name).alias("check_name"), "failing_rows")
        for name, rows in results.items()
    ]
    return reduce(DataFrame.unionByName, counts)
