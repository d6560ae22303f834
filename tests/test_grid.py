"""The allowed grid: scoped and broad exclusions, and the checks that watch over it."""

import pytest
from pyspark.sql import functions as F

from cohortgram import reference as ref
from cohortgram.functions.windows import ReportWindow
from cohortgram.operators import checks, marts
from cohortgram.sources.seeds import Seeds, small_table

CATEGORIES = {
    ref.S_AUREUS: ("overall", "oxacillin_resistant", "oxacillin_susceptible"),
    ref.E_COLI: ("base", "esce_r"),
    ref.K_OXYTOCA: ("base", "esce_r"),
    ref.K_PNEUMONIAE: ("base", "esce_r"),
    ref.E_CLOACAE: ("base", "esce_r"),
    ref.E_FAECIUM: ("base", "vancomycin_resistant"),
    ref.E_FAECALIS: ("base", "vancomycin_resistant"),
}


@pytest.fixture(scope="module")
def seeds(spark):
    return Seeds.built_in(spark)


@pytest.fixture(scope="module")
def population(spark):
    data = [
        (f"{g}|{c}|{p}|{n}", "release", c, n, g, g, p)
        for g, categories in CATEGORIES.items()
        for c in ref.COHORTS
        for p in categories
        for n in ("p1", "p2")
    ]
    columns = (marts.POPULATION, "source_version", "cohort_id", "patient_key", "organism_reporting_group", "organism_name")
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in (*columns, "reporting_phenotype")))


def grid_rows(population, seeds, exclusions=None):
    grid = marts.wildcard_exclude(marts.approved_grid(population, seeds.pairs), exclusions or seeds.exclusions)
    return grid.groupBy("cohort_id", "organism_reporting_group", "reporting_phenotype", "antibiotic").count()


@pytest.fixture(scope="module")
def grid(population, seeds):
    return {tuple(r)[:4]: r[4] for r in grid_rows(population, seeds).collect()}


def cells(grid, group, drugs):
    return {(c, p, d) for c, g, p, d in grid if g == group and d in drugs}


def test_every_cell_counts_both_patients(grid):
    assert grid and set(grid.values()) == {2}


def test_rules_are_unique_and_explicit():
    keys = [row[:4] for row in ref.exclusion_rows()]
    assert len(keys) == len(set(keys)) == 61
    for group, cohort, phenotype, drug, reason, basis, _ in ref.exclusion_rows():
        assert cohort in (ref.WILDCARD, *ref.COHORTS) and phenotype in (ref.WILDCARD, *ref.PHENOTYPES)
        assert reason in ref.EXCLUSION_REASONS and all((group, drug, basis))


def test_pairs_are_unique():
    rows = ref.pair_rows()
    assert len({r[:3] for r in rows}) == len(rows) == 322
    assert sum(r[4] for r in rows) == 311


def test_scoped_rule_keeps_the_other_categories(grid):
    assert {(c, p) for c, p, _ in cells(grid, ref.S_AUREUS, {"Oxacillin"})} == {
        (c, p) for c in ref.COHORTS for p in ("overall", "oxacillin_susceptible")
    }


def test_scoped_rule_keeps_base(grid):
    assert cells(grid, ref.E_COLI, {"Ampicillin", "Ceftriaxone"}) == {
        (c, "base", d) for c in ref.COHORTS for d in ("Ampicillin", "Ceftriaxone")
    }


def test_rule_does_not_reach_other_cohorts(grid):
    assert {(c, p) for c, p, _ in cells(grid, ref.K_PNEUMONIAE, {"Piperacillin/Tazobactam"})} == {
        ("blood", "base"),
        ("respiratory", "base"),
        ("urine", "base"),
        ("urine", "esce_r"),
    }


def test_drug_excluded_in_two_categories_of_one_group(grid):
    blood = [k for k in grid if k[0] == "blood" and k[3] == "Daptomycin"]
    assert not any(k[1] == ref.E_FAECIUM for k in blood)
    assert any(k[1] == ref.E_FAECALIS and k[2] == "base" for k in blood)


def test_broad_rules_still_apply(grid):
    kept = [k for k in grid if k[1] == ref.E_CLOACAE]
    assert kept and not any(k[3] in ("Ceftriaxone", "Piperacillin/Tazobactam") for k in kept)


def test_overlapping_rules_change_nothing(spark, population, seeds, grid):
    extra = [(ref.E_CLOACAE, "blood", "esce_r", "Ceftriaxone", "x", "x", None)] + ref.exclusion_rows()
    more = small_table(spark, ref.EXCLUSION_COLUMNS, ref.exclusion_rows() + extra)
    assert {tuple(r)[:4]: r[4] for r in grid_rows(population, seeds, more).collect()} == grid


def test_null_or_blank_is_no_wildcard(spark, population, seeds, grid):
    rules = [
        (ref.E_COLI, None, None, "Meropenem", "x", "x", None),
        (ref.E_COLI, "", "", "Meropenem", "x", "x", None),
    ]
    more = small_table(spark, ref.EXCLUSION_COLUMNS, ref.exclusion_rows() + rules)
    assert {tuple(r)[:4]: r[4] for r in grid_rows(population, seeds, more).collect()} == grid


# -- checks ----------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def mart(population, seeds):
    rows = grid_rows(population, seeds).withColumnRenamed("count", "eligible_count")
    return rows.withColumn("source_version", F.lit("release"))


@pytest.fixture(scope="module")
def expected(population, seeds):
    overall = population.filter("reporting_phenotype = 'overall'")
    stratified = population.filter("reporting_phenotype <> 'overall'")
    return checks.expected_cells(overall, stratified, seeds.pairs, seeds.exclusions)


def test_checks_accept_a_right_grid(mart, expected, seeds):
    assert checks.unapproved_or_excluded(mart, seeds.pairs, seeds.exclusions).count() == 0
    assert checks.grid_completeness(mart, expected).count() == 0
    assert checks.scoped_rules_without_pair(seeds.exclusions, seeds.pairs).count() == 0


def test_checks_reject_a_row_put_back(spark, mart, expected, seeds):
    back = spark.createDataFrame(
        [("blood", ref.S_AUREUS, "oxacillin_resistant", "Oxacillin", 2, "release")], mart.schema
    )
    wrong = mart.unionByName(back)
    failing = checks.unapproved_or_excluded(wrong, seeds.pairs, seeds.exclusions).collect()
    assert [r.failing_rule for r in failing] == ["explicitly_excluded"]
    assert checks.grid_completeness(wrong, expected).count() == 1


def target():
    return (
        (F.col("cohort_id") == "blood")
        & (F.col("organism_reporting_group") == ref.S_AUREUS)
        & (F.col("reporting_phenotype") == "overall")
        & (F.col("antibiotic") == "Oxacillin")
    )


def test_completeness_rejects_a_lost_row(mart, expected):
    failing = checks.grid_completeness(mart.filter(~target()), expected).collect()
    assert [r.reporting_phenotype for r in failing] == ["overall"]


def test_completeness_rejects_a_changed_denominator(mart, expected):
    wrong = mart.withColumn("eligible_count", F.when(target(), 99).otherwise(F.col("eligible_count")))
    assert checks.grid_completeness(wrong, expected).count() == 1


def test_scoped_rule_needs_a_pair(spark, seeds):
    rules = ref.exclusion_rows() + [(ref.E_COLI, "blood", "base", "Misspelled drug", "x", "x", None)]
    wrong = small_table(spark, ref.EXCLUSION_COLUMNS, rules)
    assert checks.scoped_rules_without_pair(wrong, seeds.pairs).count() == 1


def test_count_identity_fails_on_unknown_text(spark, population, seeds):
    """An unknown result text is not put into a bucket: the identity check finds it."""
    group = (F.col("organism_reporting_group") == ref.E_COLI) & (F.col("reporting_phenotype") == "base")
    endpoints = population.filter(group).select(
        marts.POPULATION,
        "reporting_phenotype",
        F.lit("Meropenem").alias("antibiotic"),
        F.lit("resolved").alias("resolution_status"),
        F.when(F.col("cohort_id") == "blood", "Null").otherwise("Susceptible").alias("susceptibility"),
        F.lit("resolved_consistent_result").alias("reconciliation_reason"),
    )
    mart = marts.grid_susceptibility_mart(
        population, endpoints, seeds.pairs, seeds.exclusions, seeds.groups, ReportWindow()
    )
    failing = checks.expression_is_true(mart, checks.COUNT_IDENTITY).collect()
    assert [(r.cohort_id, r.antibiotic) for r in failing] == [("blood", "Meropenem")]
