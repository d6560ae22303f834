"""Physical plans that matter at scale: shuffles, pushed filters, pruned columns, join kinds."""

import re
from datetime import date

import pytest

from cohortgram import ReportWindow
from cohortgram.operators import consolidate, marts
from cohortgram.plans import ReportTables, Scratch, windows
from cohortgram.queries import source
from cohortgram.sources.seeds import Seeds

SMALL = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return plan(frame).count("Exchange hashpartitioning")


def scans(frame):
    """Pushed filters and read columns of every file scan."""
    text = frame._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan ==") :]
    return [
        (pushed, re.findall(r"(\w+):", schema))
        for pushed, schema in re.findall(r"PushedFilters: \[(.*?)\].*?ReadSchema: struct<(.*?)>", physical)
    ]


@pytest.fixture(scope="module")
def wide(spark):
    """Plans are cut to a width for display; these tests read them whole."""
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.set("spark.sql.debug.maxToStringFields", before)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def raw(spark):
    return Scratch(spark).keep("raw", source.raw_cohort(spark, SMALL))


@pytest.fixture(scope="module")
def lean(spark, raw, wide):
    """Nothing stored: every relation shows its whole plan."""
    return ReportTables(raw, Seeds.built_in(spark), audit_columns=False)


@pytest.fixture(scope="module")
def stored(spark, raw, wide):
    window = ReportWindow(date(1998, 1, 1))
    return ReportTables(raw, Seeds.built_in(spark), window, Scratch(spark), audit_columns=False)


def test_shuffles_of_the_roll_ups(lean, raw, spark):
    audit = ReportTables(raw, Seeds.built_in(spark))
    assert shuffles(lean.staged) == 0
    assert shuffles(lean.endpoints) == 1
    assert shuffles(audit.endpoints) == 2
    assert shuffles(lean.culture_organisms) == 1
    assert shuffles(lean.cultures) == 2


def test_roll_ups_read_only_their_columns(lean):
    ((_, columns),) = scans(lean.endpoints)
    assert set(columns) == {
        "anon_id",
        "pat_enc_csn_id_coded",
        "order_proc_id_coded",
        "organism",
        "antibiotic",
        "susceptibility",
        "source_version",
    }


def test_mapping_adds_no_shuffle(lean):
    assert shuffles(lean.mapped) == shuffles(lean.cohort_records)


def test_rule_drugs_reach_the_scan_of_the_endpoints(stored):
    stored.records
    ((pushed, columns),) = scans(stored.evidence)
    assert "In(antibiotic" in pushed
    assert set(columns) == {"culture_organism_key", "organism", "antibiotic", "resolution_status", "susceptibility"}


def test_window_reaches_the_scan_of_the_records(stored):
    for frame in (stored.mdro, stored.observations):
        ((pushed, _),) = scans(frame)
        assert "GreaterThanOrEqual(culture_time_shifted" in pushed and "LessThan(culture_time_shifted" in pushed


def test_resistance_table_scans_once_and_reads_little(stored):
    ((pushed, columns),) = scans(stored.mdro)
    assert set(columns) == {
        "source_version",
        "cohort_id",
        "patient_key",
        "organism_reporting_group",
        "culture_time_shifted",
        "ast_cre_status",
        "ast_mdr_p_aeruginosa_status",
    }
    assert shuffles(stored.mdro) == 2


def test_selection_reads_the_records_once(stored):
    """One scan and one shuffle for the ranking; marker results are columns of the records."""
    ((pushed, _),) = scans(stored.first_stratified)
    assert "GreaterThanOrEqual(culture_time_shifted" in pushed
    assert shuffles(stored.first_stratified) == 1
    assert plan(stored.first_stratified).count("WindowGroupLimit") == 2


def test_markers_stay_in_the_window(stored):
    assert any("GreaterThanOrEqual(culture_time_shifted" in pushed for pushed, _ in scans(stored.markers))


def test_plan_does_not_grow_with_the_windows(stored):
    records = stored.records
    few = windows.in_windows(records, [date(1998, month, 1) for month in (1, 2)])
    many = windows.in_windows(records, [date(year, month, 1) for year in range(1992, 1999) for month in range(1, 13)])
    every = windows.in_windows(records, 1)
    assert abs(len(plan(many).splitlines()) - len(plan(few).splitlines())) <= 2
    assert len(plan(every).splitlines()) <= len(plan(few).splitlines()) + 2


def test_windows_every_so_many_months(stored):
    """The same windows as by listing their starts."""
    records = stored.records.select("reporting_culture_organism_key", "culture_time_shifted")
    for step in (1, 3, 12):
        starts = [date(year, month, 1) for year in range(1990, 2003) for month in range(1, 13, step)]
        listed, found = windows.in_windows(records, starts), windows.in_windows(records, step)
        assert listed.exceptAll(found).isEmpty() and found.exceptAll(listed).isEmpty()


def test_markers_of_records_are_those_of_their_endpoints(spark, raw):
    tables = ReportTables(raw, Seeds.built_in(spark), scratch=Scratch(spark))
    key = "reporting_culture_organism_key"
    decided = tables.markers.withColumnRenamed("reporting_source_key", key)
    own = tables.records.select(key, *consolidate.MARKER_RESULTS)
    both = decided.select(key, *consolidate.MARKER_RESULTS)
    assert not both.isEmpty() and both.exceptAll(own).isEmpty()


def test_exclusions_are_one_broadcast_anti_join(stored, spark):
    seeds = stored.seeds
    kept = marts.wildcard_exclude(marts.approved_grid(stored.selected, seeds.pairs), seeds.exclusions)
    text = plan(kept)
    assert re.search(r"BroadcastHashJoin.*LeftAnti", text)
    assert shuffles(kept) == 0


def test_larger_rule_tables_are_shuffled(stored, spark):
    """Past the threshold the same plan shuffles: nothing forces a broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        kept = marts.wildcard_exclude(marts.approved_grid(stored.selected, stored.seeds.pairs), stored.seeds.exclusions)
        assert "BroadcastHashJoin" not in plan(kept) and kept.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_operator_leaves_the_jvm_or_crosses(lean, stored):
    for frame in (lean.susceptibility, lean.mdro, stored.susceptibility, stored.group_endpoints):
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert operator not in plan(frame)
