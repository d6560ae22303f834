"""A third of all rows in one key: results stay whole and nothing of raw size meets in one task."""

import pytest
from pyspark.sql import functions as F

from cohortgram.operators import audits, profile
from cohortgram.plans import ReportTables, Scratch
from cohortgram.queries import source
from cohortgram.sources.seeds import Seeds

SMALL = "/root/testdata/sf0.001"
COPIES = 3_000


@pytest.fixture(scope="module")
def raw(spark):
    return Scratch(spark).keep("raw", source.raw_cohort(spark, SMALL))


@pytest.fixture(scope="module")
def plain(spark, raw):
    return ReportTables(raw, Seeds.built_in(spark), scratch=Scratch(spark))


def with_copies(raw, condition):
    """The raw rows plus many copies of one of them."""
    one = raw.filter(condition).orderBy(*raw.columns).limit(1)
    return raw.unionByName(one.select("*", F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("_i")).drop("_i"))


HOT = {
    "one endpoint": "organism = 'ESCHERICHIA COLI' and susceptibility = 'Resistant'",
    "one negative culture": "organism = 'Null'",
    "one culture without a drug": "organism <> 'Null' and antibiotic = 'Null'",
}


@pytest.mark.parametrize("name", HOT)
def test_repeated_rows_do_not_change_the_reports(spark, raw, plain, rows, name):
    hot = ReportTables(with_copies(raw, HOT[name]), Seeds.built_in(spark), scratch=Scratch(spark))
    assert rows(hot.susceptibility) == rows(plain.susceptibility)
    assert rows(hot.mdro) == rows(plain.mdro)
    assert hot.cultures.agg(F.sum("source_row_count")).first()[0] == raw.count() + COPIES


def test_one_patient_with_very_many_cultures(spark, raw, plain, rows):
    """All of a patient's cultures count for resistance; one per category is selected."""
    one = raw.filter("organism = 'ESCHERICHIA COLI' and antibiotic = 'Meropenem' and culture_description = 'BLOOD'")
    one = one.orderBy(*raw.columns).limit(1)
    copies = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("_i"))
    many = copies.withColumn("order_proc_id_coded", F.concat(F.lit("hot"), F.col("_i"))).withColumn(
        "anon_id", F.lit("hot")
    )
    many = many.withColumn("susceptibility", F.when(F.col("_i") == COPIES, "Resistant").otherwise("Susceptible"))
    t = ReportTables(raw.unionByName(many.drop("_i")), Seeds.built_in(spark), scratch=Scratch(spark))
    assert t.records.filter("patient_key = 'hot'").count() == COPIES
    assert t.first_stratified.filter("patient_key = 'hot'").count() == 1
    before = plain.mdro.agg(F.sum("denominator_count"), F.sum("positive_count")).first()
    after = t.mdro.agg(F.sum("denominator_count"), F.sum("positive_count")).first()
    assert (after[0] - before[0], after[1] - before[1]) == (1, 1)


def test_roll_ups_combine_before_the_shuffle(plain):
    for frame in (plain.cultures, plain.culture_organisms):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scan_side = plan[plan.rindex("Exchange hashpartitioning") :]
        assert "partial_count(1)" in scan_side


def test_profiles_of_a_hot_key(spark):
    rows_ = spark.range(90_000).select(
        F.when(F.col("id") < 30_000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 30_000).cast("string").alias("v"),
    )
    groups = profile.conflict_groups(rows_, ["k"], "v")
    assert [(r.k, r.row_count, r.state_count) for r in groups.select("k", "row_count", "state_count").collect()] == [
        ("hot", 30_000, 30_000)
    ]
    top = profile.largest_keys(rows_, ["k"], 1).first()
    assert (top.k, top.row_count) == ("hot", 30_000)
    audit = profile.join_key_audit(rows_, rows_, ["k"]).first()
    assert (audit.match, audit.key_count, audit.cardinality) == ("both", 60_001, "m:m")
    check = profile.join_row_check(rows_, rows_, ["k"]).first()
    assert check.rows_after == 30_000 * 30_000 + 60_000


def test_coverage_counts_records_once(spark):
    records = spark.createDataFrame(
        [(f"r{i}", "g", f"p{i % 4}") for i in range(10)], "culture_organism_key string, g string, patient_key string"
    )
    endpoints = spark.createDataFrame(
        [("r0", "D", "resolved", "Resistant"), ("r1", "D", "resolved", "Susceptible"), ("r2", "D", "conflict", None)],
        "culture_organism_key string, antibiotic string, resolution_status string, susceptibility string",
    )
    grid = {r.antibiotic: r for r in audits.rule_drug_coverage(records, endpoints, ["D", "E"], ["g"]).collect()}
    assert (grid["D"].tested_endpoint_records, grid["D"].resistant_records, grid["D"].not_tested_records) == (3, 1, 7)
    assert (grid["E"].tested_endpoint_records, grid["E"].culture_organism_records, grid["E"].patients) == (0, 10, 4)
