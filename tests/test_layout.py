"""Stored relations are read in the layout of their joins: no shuffle between them and the join or aggregation."""

import re

import pytest

from cohortgram.operators import reconcile, select
from cohortgram.plans import ReportTables, Scratch, quality
from cohortgram.plans.report import AUDIT_RELATIONS
from cohortgram.queries import source
from cohortgram.sources.seeds import Seeds

SMALL = "/root/testdata/sf0.001"
SELECTIONS = ("first_stratified", "first_stratified_endpoints", "first_overall", "first_overall_endpoints")


@pytest.fixture(scope="module")
def tables(spark):
    """With a threshold that only reference tables stay under, as at scale."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    cut = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    scratch = Scratch(spark)
    raw = scratch.keep("raw", source.raw_cohort(spark, SMALL))
    yield ReportTables(raw, Seeds.built_in(spark), scratch=scratch, keep=AUDIT_RELATIONS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.maxMetadataStringLength", cut)


def above(frame, folder):
    """For each scan of a stored relation, the operators from the scan up to the first join or aggregation."""
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[\s:+\-*()0-9]*", line)[0]) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and f"/{folder}-" in line:
            path, level = [], depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < level:
                    level = depth[j]
                    path.append(re.sub(r"^[\s:+\-*()0-9]*", "", lines[j]).split(" ")[0])
                    if re.match("SortMergeJoin|ShuffledHashJoin|.*Aggregate", path[-1]):
                        break
            found.append(path)
    assert found
    return found


def test_endpoints_are_not_shuffled_to_be_joined(tables):
    groups = select.marker_endpoints(tables.records, tables.endpoints)
    for frame in (tables.susceptibility, groups):
        for path in above(frame, "endpoints"):
            assert path[-1].startswith(("SortMergeJoin", "ShuffledHashJoin")) and "Exchange" not in path, path


def test_group_endpoints_of_all_scopes(spark, tables):
    usable = ReportTables(tables.raw_cohort, tables.seeds, scratch=Scratch(spark))
    usable.__dict__.update(endpoints=tables.endpoints, records=tables.records)
    for path in above(usable.group_endpoints, "endpoints"):
        assert "Exchange" not in path, path


def test_both_scopes_are_grouped_where_they_lie(spark, tables):
    usable = ReportTables(tables.raw_cohort, tables.seeds, scratch=Scratch(spark))
    usable.__dict__.update(endpoints=tables.endpoints, records=tables.records)
    plan = usable.group_endpoints._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "Exchange hashpartitioning" not in plan


def test_evidence_is_counted_where_the_endpoints_lie(tables):
    for path in above(tables.evidence, "endpoints"):
        assert "Aggregate" in path[-1] and "Exchange" not in path, path


def test_endpoints_of_selected_records(tables):
    for frame in (tables.first_stratified_endpoints, tables.first_overall_endpoints):
        for path in above(frame, "group_endpoints"):
            assert "Exchange" not in path, path


def test_checks_and_reports_read_selections_that_were_ranked_once(tables):
    for frame in (quality.quality_report(tables, relations=SELECTIONS), tables.population, tables.first_overall_endpoints):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "/first_" in plan and "Window" not in plan
    for frame in (tables.first_stratified_endpoints, tables.first_overall_endpoints):
        assert "Exchange hashpartitioning" not in frame._jdf.queryExecution().executedPlan().toString()


def test_buckets_hold_what_was_written(spark, tables, rows):
    plain = ReportTables(tables.raw_cohort, tables.seeds)
    for name in ("endpoints", "records"):
        columns = [c for c in getattr(plain, name).columns]
        assert rows(getattr(tables, name), *columns) == rows(getattr(plain, name), *columns)


def test_reconcile_group_over_buckets_and_files(spark, tables, rows):
    plain = ReportTables(tables.raw_cohort, tables.seeds)
    groups = tables.records.select(select.RECORD_KEY, "source_culture_organism_keys")
    columns = [select.RECORD_KEY, "antibiotic", "resolution_status", "susceptibility", "reconciliation_reason"]
    found = [reconcile.reconcile_group(groups, e, [select.RECORD_KEY]) for e in (tables.endpoints, plain.endpoints)]
    assert rows(found[0], *columns) == rows(found[1], *columns)
