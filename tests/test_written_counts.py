"""Checks and counts taken while relations are written."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortgram import ReportWindow
from cohortgram.operators import checks, profile
from cohortgram.plans import ReportTables, Scratch, quality
from cohortgram.plans.report import AUDIT_RELATIONS
from cohortgram.queries import source
from cohortgram.sources.seeds import Seeds

SMALL = "/root/testdata/sf0.001"
RELATIONS = ("cultures", "culture_organisms", "endpoints", "mapped", "phenotypes", "records", "group_endpoints", "staged")


def built(spark, **more):
    raw = Scratch(spark).keep("raw", source.raw_cohort(spark, SMALL))
    return ReportTables(raw, Seeds.built_in(spark), scratch=Scratch(spark), keep=AUDIT_RELATIONS, **more)


@pytest.fixture(scope="module")
def counted(spark):
    return built(spark, counts=quality.written_counts)


def scans(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Relation ")


def test_counts_taken_while_writing_give_the_same_report(spark, counted, rows):
    observed = quality.quality_report(counted, relations=RELATIONS)
    counted_before, counted.counted = counted.counted, {}
    scanned = quality.quality_report(counted, relations=RELATIONS)
    counted.counted = counted_before
    assert set(RELATIONS) - set(counted_before) == {"staged"}
    assert rows(observed) == rows(scanned)
    # One scan fewer for each relation that was counted.
    assert scans(scanned) - scans(observed) == len(RELATIONS) - 1
    for name, counts in counted_before.items():
        assert counts[quality.ROWS] == getattr(counted, name).count()


def test_without_counts_everything_is_scanned(spark, counted, rows):
    plain = built(spark)
    report = quality.quality_report(plain, relations=("cultures", "endpoints"))
    assert plain.counted == {}
    assert rows(report) == rows(quality.quality_report(counted, relations=("cultures", "endpoints")))


def test_another_window_counts_its_own_relations(counted):
    narrow = counted.for_window(ReportWindow(date(1998, 1, 1)))
    assert narrow.counted["records"] == counted.counted["records"] and "group_endpoints" not in narrow.counted
    inside = narrow.group_endpoints.count()
    assert narrow.counted["group_endpoints"][quality.ROWS] == inside < counted.group_endpoints.count()


def test_a_relation_given_from_outside_is_scanned(counted):
    again = counted.cultures.unionByName(counted.cultures.withColumn("culture_key", F.lit(None).cast("string")))
    report = quality.quality_report(counted, {"cultures": again}, ("cultures",))
    failing = {r.check_name: r.failing_rows for r in report.collect()}
    assert failing["culture_key is not null"] == counted.cultures.count()


def test_faults_are_counted_in_plain_and_bucketed_tables(spark):
    frame = spark.range(2000).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("key"), (F.col("id") % 3).cast("string").alias("kind"), "id"
    )
    conditions = checks.not_null_checks(["key"]) | checks.accepted_checks({"kind": ["0", "1"]}) | {"id < 1500": F.expr("id < 1500")}
    counts, scratch = {quality.ROWS: F.count(F.lit(1))} | checks.failing_counts(conditions), Scratch(spark)
    plain, dealt = scratch.keep("plain", frame, counts=counts), scratch.keep_by("dealt", frame, "id", counts)
    expected = {r.check_name: r.failing_rows for r in checks.row_checks(frame, conditions).collect()}
    assert expected == {"key is not null": 286, "kind is accepted": 666, "id < 1500": 500}
    assert scratch.counted["plain"] == scratch.counted["dealt"] == {quality.ROWS: 2000} | expected
    assert plain.count() == dealt.count() == 2000


def test_no_rows_are_counted_too(spark):
    scratch = Scratch(spark)
    empty = spark.range(10).where("id > 10")
    scratch.keep_by("none", empty, "id", {quality.ROWS: F.count(F.lit(1))})
    layers = {"none": empty, "some": spark.range(3)}
    got = quality.layer_counts(layers, scratch.counted)
    assert {r.model_name: r.row_count for r in got.collect()} == {"none": 0, "some": 3}
    assert profile.layer_counts(layers).count() == 2


def test_key_checks_compare_packed_keys(spark):
    key = "0123456789abcdef0123456789abcdef"
    rows = [(k, "x", "c") for k in (key, key.upper(), "0", "00", "", None, None)]
    children = spark.createDataFrame(rows, "susceptibility_key string, culture_organism_key string, culture_key string")
    parents = spark.createDataFrame([(key,), ("0",)], "susceptibility_key string")
    contract = quality.Contract(
        required=("culture_key",), unique=(("susceptibility_key",),), references={"susceptibility_key": ("parents", "susceptibility_key")}
    )
    report = quality.relation_report("children", children, lambda name: parents, contract)
    assert {r.check_name: r.failing_rows for r in report.collect()} == {
        "culture_key is not null": 0,
        "susceptibility_key is unique": 1,
        "susceptibility_key is in parents": 3,
    }
    narrow = quality.comparable(children, ("susceptibility_key",))
    assert dict(narrow.dtypes) == {"susceptibility_key": "binary"}
    assert dict(quality.comparable(children, ("susceptibility_key", "culture_key")).dtypes)["susceptibility_key"] == "string"


def test_relations_are_stored_when_they_are_asked_for(spark, rows):
    tables = built(spark, counts=quality.written_counts)
    setting = "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(setting, None)
    records = rows(tables.records)
    assert set(tables.counted) == {"states", "endpoints", "records"} and spark.conf.get(setting, None) == before
    assert tables.phenotypes.count() == tables.counted["phenotypes"][quality.ROWS] > 0
    assert set(tables.counted) == {"states", "endpoints", "records", "phenotypes"}
    again = built(spark, counts=quality.written_counts)
    assert again.mapped.count() and again.cultures.count() and again.phenotypes.count()
    assert rows(again.records) == records
    assert set(again.counted) == {"states", "cultures", "mapped", "endpoints", "phenotypes", "records"}
