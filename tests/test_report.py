"""Whole reports on a small literal release."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortgram import ReportWindow
from cohortgram.functions.schemas import COHORT_SCHEMA
from cohortgram.operators import checks, marts
from cohortgram.operators import select as sel
from cohortgram.plans import ReportTables, Scratch
from cohortgram.plans.report import AUDIT_RELATIONS
from cohortgram.queries import source
from cohortgram.sources.seeds import Seeds

SMALL = "/root/testdata/sf0.001"
ECOLI, SAUREUS = "ESCHERICHIA COLI", "STAPHYLOCOCCUS AUREUS"


def culture(patient, order, time, label, results, description="BLOOD"):
    return [
        (patient, f"v{patient}", order, time, "Inpatient", description, "1", label, drug, value)
        for drug, value in (results or [("Null", "Null")])
    ]


def raw_frame(spark, data):
    return spark.createDataFrame(data, COHORT_SCHEMA).select(
        "*",
        F.lit("file").alias("source_file"),
        F.lit("r1").alias("source_version"),
        F.lit("2025-01-01").cast("timestamp").alias("ingested_at"),
    )


S, R = "Susceptible", "Resistant"
RELEASE = [
    *culture("p1", "c1", "2022-03-01 00:00:00", ECOLI, [("Ceftriaxone", S), ("Meropenem", S)]),
    *culture("p1", "c2", "2023-02-01 00:00:00", ECOLI, [("Ceftriaxone", R), ("Meropenem", S)]),
    *culture("p1", "c3", "2023-06-01 00:00:00", ECOLI, [("Ceftriaxone", S), ("Gentamicin", R)]),
    *culture("p2", "c4", "2023-01-01 00:00:00", ECOLI, [("Meropenem", S), ("Meropenem", R)]),
    *culture("p2", "c5", "2024-01-01 00:00:00", ECOLI, [("Meropenem", R)]),
    *culture("p3", "c6", "no time", ECOLI, [("Meropenem", S)]),
    *culture("p4", "c7", "2023-05-01 00:00:00", SAUREUS, [("Oxacillin", S), ("Vancomycin", S)]),
    *culture("p4", "c8", "2023-07-01 00:00:00", "STAPH AUREUS {MRSA}", [("Oxacillin", R)]),
    *culture("p5", "c9", "2023-08-01 00:00:00", SAUREUS, [("Vancomycin", S)]),
    *culture("p6", "c10", "2023-09-01 00:00:00", ECOLI, None),
    *culture("p7", "c11", "2023-09-01 00:00:00", ECOLI, [("Meropenem", S)], "WOUND"),
]


@pytest.fixture(scope="module")
def release(spark):
    return raw_frame(spark, RELEASE)


def tables(spark, raw, window=None, **options):
    return ReportTables(raw, Seeds.built_in(spark), window or ReportWindow(), **options)


def chosen(t):
    rows = t.first_stratified.select("patient_key", "reporting_phenotype", "culture_key")
    names = {r.culture_key: r.culture_order_key for r in t.cultures.collect()}
    return {(r.patient_key, r.reporting_phenotype): names[r.culture_key] for r in rows.collect()}


def test_first_culture_per_category(spark, release):
    picked = chosen(tables(spark, release))
    assert picked == {
        ("p1", "base"): "c1",
        ("p1", "esce_r"): "c2",
        ("p2", "base"): "c4",
        ("p4", "oxacillin_susceptible"): "c7",
        ("p4", "oxacillin_resistant"): "c8",
        ("p6", "base"): "c10",
    }


def test_window_comes_before_selection(spark, release):
    picked = chosen(tables(spark, release, ReportWindow(date(2023, 1, 1))))
    assert picked[("p1", "base")] == "c3" and picked[("p1", "esce_r")] == "c2"
    assert picked[("p2", "base")] == "c4"


def test_equal_times_fall_to_the_lower_keys(spark):
    frame = spark.createDataFrame([("p", 1, "b", "x"), ("p", 1, "a", "z"), ("p", 1, "a", "y")], "p string, t int, c string, r string")
    assert sel.first_per_group(frame, ["p"], ["t", "c", "r"]).first().r == "y"


def test_susceptibility_rows(spark, release):
    t = tables(spark, release, ReportWindow(date(2023, 1, 1)))
    got = {
        (r.organism_reporting_group, r.reporting_phenotype, r.antibiotic): r for r in t.susceptibility.collect()
    }
    base = got[("Escherichia coli", "base", "Meropenem")]
    assert (base.eligible_count, base.tested_endpoint_count, base.conflict_result_count, base.untested_count) == (3, 1, 1, 2)
    assert (base.susceptible_pct, base.categorized_result_coverage_pct) == (None, 0.0)
    gentamicin = got[("Escherichia coli", "base", "Gentamicin")]
    assert (gentamicin.resistant_count, gentamicin.resistant_pct, gentamicin.categorized_result_coverage_pct) == (1, 100.0, 33.3)
    assert ("Escherichia coli", "esce_r", "Ceftriaxone") not in got
    overall = got[("Staphylococcus aureus", "overall", "Oxacillin")]
    assert (overall.eligible_count, overall.susceptible_count, overall.untested_count) == (2, 1, 1)
    assert overall.display_status == "insufficient_data" and overall.gram_stain_group == "gram_positive"
    assert overall.organism_name == "Staphylococcus aureus"
    assert got[("Staphylococcus aureus", "oxacillin_susceptible", "Oxacillin")].organism_name.endswith("— MSSA")
    assert str(base.analysis_window_start) == "2023-01-01" and str(base.analysis_window_end_exclusive) == "2024-01-01"


def test_mdro_counts_every_culture(spark, release):
    full = {r.organism_base_name: r for r in tables(spark, release).mdro.collect()}
    row = full["Escherichia coli"]
    # p1 has a culture without carbapenem results, p2 is positive through a later culture, p6 was never
    # tested; p3 has no time and p7 no cohort.
    assert (row.denominator_count, row.positive_count, row.not_detected_count, row.not_evaluable_count) == (3, 1, 0, 2)
    assert (row.evaluable_count, row.phenotype_pct, row.evaluable_pct) == (1, 33.3, 33.3)


def test_row_order_and_repeats_of_rules_do_not_matter(spark, release, rows):
    shuffled = raw_frame(spark, random.Random(3).sample(RELEASE, len(RELEASE))).repartition(4)
    assert rows(tables(spark, release).susceptibility) == rows(tables(spark, shuffled).susceptibility)


def test_wider_window_never_lowers_the_denominator(spark, release):
    def total(window):
        return tables(spark, release, window).mdro.agg(F.sum("denominator_count")).first()[0]

    assert total(ReportWindow()) >= total(ReportWindow(date(2023, 1, 1)))


@pytest.fixture(scope="module")
def derived(spark):
    return source.raw_cohort(spark, SMALL)


def test_lean_and_full_relations_give_the_same_reports(spark, derived, rows):
    full = tables(spark, derived, scratch=Scratch(spark), keep=AUDIT_RELATIONS)
    lean = tables(spark, derived, audit_columns=False)
    assert rows(full.susceptibility) == rows(lean.susceptibility)
    assert rows(full.mdro) == rows(lean.mdro)


def test_cells_and_grid_give_the_same_table(spark, derived, rows):
    t = tables(spark, derived, ReportWindow(date(1998, 1, 1)), scratch=Scratch(spark))
    s = t.seeds
    grid = marts.grid_susceptibility_mart(
        t.population, t.population_endpoints, s.pairs, s.exclusions, s.groups, t.window
    )
    columns = t.susceptibility.columns
    assert rows(t.susceptibility, *columns) == rows(grid, *columns)


def test_report_checks_find_a_wrong_selection(spark, derived):
    t = tables(spark, derived, scratch=Scratch(spark))
    assert checks.first_record_rebuild(t.candidates, t.first_stratified).count() == 0
    late = t.first_stratified.join(
        t.candidates.groupBy(*sel.CATEGORY_KEYS).agg(F.max(sel.RECORD_KEY).alias("other")), list(sel.CATEGORY_KEYS)
    ).withColumn(sel.RECORD_KEY, F.col("other"))
    assert checks.first_record_rebuild(t.candidates, late).count() > 0


def test_one_patient_with_a_third_of_all_rows(spark, rows):
    """A hot patient goes through selection in full; the plan limits it before the shuffle."""
    hot = spark.range(60_000).select(
        F.lit("hot").alias("patient"), F.col("id").alias("t"), F.concat(F.lit("c"), F.col("id")).alias("culture")
    )
    cold = spark.range(120_000).select(
        (F.col("id") % 40_000).cast("string").alias("patient"), F.col("id").alias("t"), F.concat(F.lit("d"), "id").alias("culture")
    )
    first = sel.first_per_group(hot.unionByName(cold), ["patient"], ["t", "culture"])
    assert first.count() == 40_001
    assert first.filter("patient = 'hot'").first().culture == "c0"
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_reports_have_no_cross_join_and_no_python(spark, derived):
    t = tables(spark, derived)
    for frame in (t.susceptibility, t.mdro):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
            assert operator not in plan
