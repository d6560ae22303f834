import random

import pytest
from pyspark.sql import functions as F

from cohortgram.operators import reconcile, rollup

S, R, I = "Susceptible", "Resistant", "Intermediate"
KEYS = ["k"]


def endpoints(spark, groups, **options):
    data = [(name, v) for name, values in groups.items() for v in values]
    return reconcile.reconcile_endpoints(
        spark.createDataFrame(data, "k string, susceptibility string"), KEYS, lineage=(), **options
    )


GROUPS = {"one": [S], "same": [S, S], "none": [None, None], "gap": [S, None], "two": [S, R], "three": [S, R, R, None]}
EXPECTED = {
    "one": ("resolved", S, 1, 0),
    "same": ("resolved", S, 1, 1),
    "none": ("missing", None, 1, 1),
    "gap": ("conflict", None, 2, 0),
    "two": ("conflict", None, 2, 0),
    "three": ("conflict", None, 3, 1),
}


def test_first_reconciliation(spark):
    got = {
        r.k: (r.resolution_status, r.susceptibility, r.distinct_result_state_count, r.repeated_result_row_count)
        for r in endpoints(spark, GROUPS).collect()
    }
    assert got == EXPECTED


def test_state_counts_do_not_change_the_status(spark, rows):
    columns = ("k", "source_row_count", "missing_susceptibility_row_count", "resolution_status", "susceptibility")
    full, lean = endpoints(spark, GROUPS), endpoints(spark, GROUPS, state_counts=False)
    assert rows(full, *columns) == rows(lean, *columns)


def test_one_endpoint_with_very_many_rows(spark):
    hot = spark.range(200_000).select(F.lit("hot").alias("k"), F.lit(S).alias("susceptibility"))
    cold = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(R).alias("susceptibility"))
    result = reconcile.reconcile_endpoints(hot.unionByName(cold), KEYS, lineage=())
    assert result.count() == 1001
    assert result.filter("k = 'hot'").first().source_row_count == 200_000


RESOLVED = "resolved"


@pytest.mark.parametrize(
    "sources, status, value, reason",
    [
        ([(RESOLVED, S)], "resolved", S, "resolved_consistent_result"),
        ([(RESOLVED, S), (RESOLVED, S)], "resolved", S, "resolved_consistent_result"),
        ([(RESOLVED, S), ("missing", None)], "resolved", S, "resolved_with_missing_source_endpoint"),
        ([(RESOLVED, S), (RESOLVED, R)], "conflict", None, "discordant_source_results"),
        ([(RESOLVED, S), ("conflict", None)], "conflict", None, "source_endpoint_conflict"),
        ([("missing", None)], "missing", None, "missing_only"),
    ],
)
@pytest.mark.parametrize("result_sets", [True, False])
def test_second_reconciliation(spark, sources, status, value, reason, result_sets):
    members = [f"m{i}" for i in range(len(sources))]
    groups = spark.createDataFrame([("g", members)], "g string, source_culture_organism_keys array<string>")
    data = [(m, "Drug", s, v) for m, (s, v) in zip(members, sources)]
    facts = spark.createDataFrame(
        data, "culture_organism_key string, antibiotic string, resolution_status string, susceptibility string"
    )
    row = reconcile.reconcile_group(groups, facts, ["g"], result_sets=result_sets).first()
    assert (row.resolution_status, row.susceptibility, row.reconciliation_reason) == (status, value, reason)


def test_single_value_never_throws(spark):
    frame = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (None,)], "v array<string>")
    assert [r[0] for r in frame.select(reconcile.single_value("v")).collect()] == [None, "a", None, None]


@pytest.mark.parametrize(
    "values, kept, conflict",
    [(["A", "A"], "A", False), (["A", None], None, True), ([None, None], None, False), (["A", "B"], None, True)],
)
def test_consistent_rollup(spark, values, kept, conflict):
    frame = spark.createDataFrame([("k", v) for v in values], "k string, v string")
    row = rollup.consistent_rollup(frame, ["k"], ["v"], "key", lineage=()).first()
    assert (row.v, row.has_order_level_conflict, row.source_row_count) == (kept, conflict, len(values))


def test_rollups_do_not_depend_on_row_order(spark, rows):
    data = [(f"k{i % 7}", random.Random(i).choice(["a", "b", None]), f"d{i % 3}", f"f{i % 5}", i) for i in range(200)]
    schema = "k string, v string, drug string, source_file string, ingested_at int"
    shuffled = random.Random(5).sample(data, len(data))
    for build in (
        lambda f: rollup.consistent_rollup(f, ["k"], ["v"], "key"),
        lambda f: rollup.child_rollup(f, ["k"], "v", "drug", "p", "c"),
    ):
        left = build(spark.createDataFrame(data, schema))
        assert rows(left) == rows(build(spark.createDataFrame(shuffled, schema).repartition(5)))


def test_child_rollup_counts(spark):
    data = [("k", "x", "d1"), ("k", "x", "d1"), ("k", "x", None), ("k", "y", None), ("k", None, "d1"), (None, "x", "d1")]
    frame = spark.createDataFrame(data, "k string, organism string, drug string")
    result = rollup.child_rollup(frame, ["k"], "organism", "drug", "parent", "child", lineage=())
    got = {
        r.organism: (r.source_row_count, r.drug_result_row_count, r.distinct_drug_count, r.has_repeated_drug_records)
        for r in result.collect()
    }
    assert got == {"x": (3, 2, 1, True), "y": (1, 0, 0, False)}
    assert result.first().parent is not None
