"""The susceptibility and resistance tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.keys import surrogate_key
from cohortgram.functions.measures import DISPLAY_MINIMUM, display_status, n_rows, safe_pct, tally
from cohortgram.functions.statuses import NOT_APPLICABLE, NOT_DETECTED, NOT_EVALUABLE, POSITIVE, strongest_status
from cohortgram.functions.windows import ReportWindow
from cohortgram.operators.consolidate import MEMBERS
from cohortgram.operators.reconcile import CONFLICT, MISSING, PARENT, RESOLVED, reconcile_group, shared_parent
from cohortgram.operators.select import PATIENT_GROUP
from cohortgram.reference import (
    CATEGORISED,
    INCONCLUSIVE,
    INTERMEDIATE,
    MDRO_LABELS,
    RESISTANT,
    SUSCEPTIBLE,
    SYNERGISM,
    WILDCARD,
    Rule,
)

POPULATION = "selected_reporting_isolate_key"
CELL = ("source_version", "cohort_id", "organism_reporting_group", "organism_name", "reporting_phenotype")
MDRO_KEYS = ("source_version", "cohort_id", "organism_base_name", "mdro_phenotype")
RESULT = ("antibiotic", "resolution_status", "susceptibility", "reconciliation_reason")


# -- populations and endpoints ---------------------------------------------------------------------
def union_populations(overall: DataFrame, stratified: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Overall and per-category selections as one population table."""
    columns = (*carry, *PATIENT_GROUP, "organism_name")
    return overall.select(
        F.col("overall_reporting_isolate_key").alias(POPULATION), *columns, F.lit("overall").alias("reporting_phenotype")
    ).unionByName(
        stratified.select(
            F.col("first_stratified_reporting_culture_key").alias(POPULATION), *columns, "reporting_phenotype"
        )
    )


def union_endpoints(overall: DataFrame, stratified: DataFrame) -> DataFrame:
    return overall.select(
        F.col("overall_reporting_isolate_key").alias(POPULATION), F.lit("overall").alias("reporting_phenotype"), *RESULT
    ).unionByName(
        stratified.select(
            F.col("first_stratified_reporting_culture_key").alias(POPULATION), "reporting_phenotype", *RESULT
        )
    )


# -- the allowed grid ------------------------------------------------------------------------------
def active_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter((F.col("include_primary_dashboard") == 1) & (F.col("review_status") == "reviewed")).select(
        "organism_reporting_group", "cohort_id", "antibiotic", "pair_order"
    )


def approved_grid(population: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every selected row with every active drug of its group and cohort, tested or not."""
    return population.join(active_pairs(pairs), ["organism_reporting_group", "cohort_id"])


def by_pattern(rules: DataFrame, scoped: Sequence[str]) -> Iterator[tuple[tuple[str, ...], DataFrame]]:
    """Rules by the scoped columns that they name; the others hold the literal wildcard. No rule is in two patterns.

    Within a pattern a rule covers a row by equality alone, so a join needs no condition beside its keys, and however many rules one drug has,
    a row meets those of its own scope only.
    """
    for n in range(len(scoped) + 1):
        for named in combinations(scoped, n):
            kind = [F.col(c) != WILDCARD if c in named else F.col(c) == WILDCARD for c in scoped]
            yield named, rules.filter(reduce(Column.__and__, kind, F.lit(True)))


def wildcard_exclude(
    grid: DataFrame,
    rules: DataFrame,
    equal: Sequence[str] = ("organism_reporting_group", "antibiotic"),
    scoped: Sequence[str] = ("cohort_id", "reporting_phenotype"),
) -> DataFrame:
    """Rows no rule matches: equal columns match, scoped ones match or are a literal wildcard of the rule.

    One anti join per pattern, so overlapping rules never multiply rows.
    """
    columns = grid.columns
    for named, some in by_pattern(rules, scoped):
        keys = [*equal, *named]
        grid = grid.join(some.select(*keys), keys, "left_anti")
    return grid.select(*columns)


def wildcard_cover(
    grid: DataFrame,
    rules: DataFrame,
    equal: Sequence[str] = ("organism_reporting_group", "antibiotic"),
    scoped: Sequence[str] = ("cohort_id", "reporting_phenotype"),
) -> DataFrame:
    """Rows some rule matches, each once."""
    columns = grid.columns
    marks = []
    for number, (named, some) in enumerate(by_pattern(rules, scoped)):
        keys, mark = [*equal, *named], f"_pattern_{number}"
        grid = grid.join(some.select(*keys, F.lit(True).alias(mark)).distinct(), keys, "left")
        marks.append(F.col(mark))
    return grid.filter(F.coalesce(*marks)).select(*columns)


def outer_attach(grid: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Grid rows with their endpoint, if the drug was tested on the selected record."""
    return grid.join(endpoints, [POPULATION, "reporting_phenotype", "antibiotic"], "left")


# -- counts and measures ---------------------------------------------------------------------------
def _resolved_as(*values: str) -> Column:
    return tally((F.col("resolution_status") == RESOLVED) & F.col("susceptibility").isin(*values))


def result_counts() -> list[Column]:
    """Counts over endpoint rows, all but the eligible and untested ones."""
    status = F.col("resolution_status")
    return [
        F.count(status).alias("tested_endpoint_count"),
        _resolved_as(*CATEGORISED).alias("categorized_count"),
        _resolved_as(SUSCEPTIBLE).alias("susceptible_count"),
        _resolved_as(RESISTANT).alias("resistant_count"),
        _resolved_as(INTERMEDIATE).alias("intermediate_count"),
        _resolved_as(INCONCLUSIVE).alias("inconclusive_count"),
        _resolved_as(SYNERGISM).alias("synergism_count"),
        tally(status == MISSING).alias("missing_result_count"),
        tally(status == CONFLICT).alias("conflict_result_count"),
    ]


RESULT_COUNT_NAMES = (
    "tested_endpoint_count",
    "categorized_count",
    "susceptible_count",
    "resistant_count",
    "intermediate_count",
    "inconclusive_count",
    "synergism_count",
    "missing_result_count",
    "conflict_result_count",
)


def endpoint_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The eleven counts over grid rows with their endpoints attached."""
    return rows.groupBy(*keys).agg(
        n_rows().alias("eligible_count"),
        *result_counts(),
        tally(F.col("resolution_status").isNull()).alias("untested_count"),
    )


def susceptibility_measures(counts: DataFrame, minimum: int = DISPLAY_MINIMUM) -> DataFrame:
    return counts.select(
        "*",
        safe_pct("categorized_count", "eligible_count").alias("categorized_result_coverage_pct"),
        safe_pct("susceptible_count", "categorized_count").alias("susceptible_pct"),
        safe_pct("resistant_count", "categorized_count").alias("resistant_pct"),
        display_status("categorized_count", minimum).alias("display_status"),
    )


def attach_attribute(rows: DataFrame, attributes: DataFrame, key: str, attribute_key: str) -> DataFrame:
    """Left join of a small attribute table."""
    return rows.join(attributes.withColumnRenamed(attribute_key, key), key, "left")


# -- susceptibility table --------------------------------------------------------------------------
def selected_members(overall: DataFrame, stratified: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The selected rows of both scopes as groups of source records."""
    overall_keys = overall.select(F.col("overall_reporting_isolate_key").alias(POPULATION), "*").withColumn(
        "reporting_phenotype", F.lit("overall")
    )
    stratified_keys = stratified.withColumn(POPULATION, F.col("first_stratified_reporting_culture_key"))
    columns = (POPULATION, *carry, *CELL, PARENT, MEMBERS)
    return overall_keys.select(*columns).unionByName(stratified_keys.select(*columns))


def panel_cells(cells: DataFrame, pairs: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Report cells with their allowed drugs.

    A cell is version × cohort × group × category. Allow-list and exclusions read nothing else, so they
    are settled on cells and the records are never multiplied by the panel.
    """
    return wildcard_exclude(approved_grid(cells, pairs), exclusions)


def susceptibility_mart(
    selected: DataFrame,
    endpoints: DataFrame,
    pairs: DataFrame,
    exclusions: DataFrame,
    groups: DataFrame,
    window: ReportWindow,
    minimum: int = DISPLAY_MINIMUM,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The susceptibility table from the selected records (`selected_members`) and first-level endpoints.

    Only endpoints of selected records, on drugs of the panel, are reconciled and counted. The eligible
    count of a cell is its number of selected records; a record without an endpoint is untested.
    """
    dimensions = [*carry, *CELL]
    cells = selected.groupBy(*dimensions).agg(n_rows().alias("eligible_count"))
    panel = panel_cells(cells, pairs, exclusions)

    drugs = active_pairs(pairs).select("antibiotic").distinct()
    results = reconcile_group(
        selected,
        endpoints.join(drugs, "antibiotic", "left_semi"),
        (POPULATION, *dimensions),
        result_sets=False,
        parent=shared_parent(selected, endpoints),
    )
    counted = results.groupBy(*dimensions, "antibiotic").agg(*result_counts())
    return measured_panel(panel, counted, dimensions, groups, window if not carry else None, minimum)


def measured_panel(
    panel: DataFrame,
    counted: DataFrame,
    dimensions: Sequence[str],
    groups: DataFrame,
    window: ReportWindow | None,
    minimum: int = DISPLAY_MINIMUM,
) -> DataFrame:
    """The table from the cells with their allowed drugs and the counts of the drugs that were tested."""
    counts = panel.join(counted, [*dimensions, "antibiotic"], "left").select(
        *dimensions,
        "antibiotic",
        "pair_order",
        "eligible_count",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in RESULT_COUNT_NAMES],
    )
    untested = F.col("eligible_count") - F.col("tested_endpoint_count")
    measured = susceptibility_measures(counts.withColumn("untested_count", untested), minimum)
    return finish_susceptibility(measured, groups, window)


def grid_susceptibility_mart(
    population: DataFrame,
    endpoints: DataFrame,
    pairs: DataFrame,
    exclusions: DataFrame,
    groups: DataFrame,
    window: ReportWindow,
    minimum: int = DISPLAY_MINIMUM,
) -> DataFrame:
    """The same table by way of the full record × drug grid, for checks and for record-level listings."""
    grid = outer_attach(wildcard_exclude(approved_grid(population, pairs), exclusions), endpoints)
    counts = endpoint_counts(grid, [*CELL, "antibiotic", "pair_order"])
    return finish_susceptibility(susceptibility_measures(counts, minimum), groups, window)


def finish_susceptibility(measured: DataFrame, groups: DataFrame, window: ReportWindow | None) -> DataFrame:
    key = surrogate_key(
        "source_version", "cohort_id", "organism_reporting_group", "reporting_phenotype", "antibiotic"
    )
    finished = measured.select(
        key.alias("susceptibility_mart_key"), "*", *(window.columns() if window is not None else [])
    )
    return attach_attribute(finished, groups, "organism_reporting_group", "organism_reporting_group")


# -- resistance table ------------------------------------------------------------------------------
def status_long(
    records: DataFrame, rules: Sequence[tuple[Rule, str]], carry: Sequence[str], name: str, status: str
) -> DataFrame:
    """One row per record and rule, in a single scan of the records."""
    pairs = F.array(*[F.struct(F.lit(label).alias(name), F.col(rule.status).alias(status)) for rule, label in rules])
    return records.select(*carry, F.inline(pairs))


def applicable_status(records: DataFrame, rules: Sequence[tuple[Rule, str]], carry: Sequence[str]) -> DataFrame:
    """``mdro_phenotype, status`` of every record and rule that applies to it."""
    applicable = reduce(lambda a, b: a | b, [F.col(rule.status) != NOT_APPLICABLE for rule, _ in rules])
    listed = status_long(records.filter(applicable), rules, carry, "mdro_phenotype", "status")
    return listed.filter(F.col("status") != NOT_APPLICABLE)


def patient_status(
    records: DataFrame,
    window: ReportWindow,
    rules: Sequence[tuple[Rule, str]] = MDRO_LABELS,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """One status per patient, group and rule, over all cultures in the window, not only the first."""
    keys = [*extra_keys, *PATIENT_GROUP]
    observed = applicable_status(records.filter(window.usable("culture_time_shifted")), rules, keys)
    return observed.groupBy(*keys, "mdro_phenotype").agg(
        strongest_status("status", fallback=None).alias("phenotype_status")
    )


def status_summary(patients: DataFrame, keys: Sequence[str]) -> DataFrame:
    status = F.col("phenotype_status")
    return patients.groupBy(*keys).agg(
        n_rows().alias("denominator_count"),
        tally(status == POSITIVE).alias("positive_count"),
        tally(status == NOT_DETECTED).alias("not_detected_count"),
        tally(status == NOT_EVALUABLE).alias("not_evaluable_count"),
    )


def mdro_mart(
    records: DataFrame,
    groups: DataFrame,
    window: ReportWindow,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """The resistance table. Both percentages use the full denominator."""
    patients = patient_status(records, window, extra_keys=extra_keys).withColumnRenamed(
        "organism_reporting_group", "organism_base_name"
    )
    summary = status_summary(patients, [*extra_keys, *MDRO_KEYS])
    return finish_mdro(summary, groups, None if extra_keys else window)


def finish_mdro(summary: DataFrame, groups: DataFrame, window: ReportWindow | None) -> DataFrame:
    """The table from the numbers of patients by status."""
    evaluable = F.col("positive_count") + F.col("not_detected_count")
    finished = summary.withColumn("evaluable_count", evaluable).select(
        surrogate_key(*MDRO_KEYS).alias("mdro_mart_key"),
        "*",
        safe_pct("positive_count", "denominator_count").alias("phenotype_pct"),
        safe_pct("evaluable_count", "denominator_count").alias("evaluable_pct"),
        *([] if window is None else window.columns()),
    )
    return attach_attribute(finished, groups, "organism_base_name", "organism_reporting_group")


