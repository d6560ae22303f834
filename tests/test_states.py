"""Raw rows are shuffled once, by culture; all grains of the source are rolled up where they lie."""

import pytest
from pyspark.sql import functions as F

from cohortgram.functions.schemas import COHORT_SCHEMA, ORDER_KEYS
from cohortgram.operators import rollup
from cohortgram.plans import ReportTables, Scratch, storage
from cohortgram.plans.report import AUDIT_RELATIONS
from cohortgram.queries import source
from cohortgram.queries.context import Context
from cohortgram.sources.seeds import Seeds

GRAINS = ("cultures", "culture_organisms", "endpoints", "mapped", "phenotypes", "records")
DRUGS = ("Ceftriaxone", "Meropenem", "Oxacillin", "Cefoxitin", None)
LABELS = ("ESCHERICHIA COLI", "STAPHYLOCOCCUS AUREUS", "STAPH AUREUS {MRSA}", "Null", None)
RESULTS = ("Susceptible", "Resistant", " Null ", "Null", None, "Intermediate")


@pytest.fixture(scope="module")
def raw(spark):
    """Repeated rows, parts of keys that are NULL, times that differ within a culture, and one hot culture."""
    rows = [
        (
            f"P{i % 7}" if i % 11 else None,
            f"V{i % 3}",
            f"C{i % 13}" if i % 17 else None,
            f"199{i % 10}-03-0{i % 2 + 1} 10:00:00" if i % 5 else None,
            "Inpatient",
            ("BLOOD", "URINE")[i % 2 if i % 23 == 0 else 0],
            ("1", "0", None)[i % 3],
            LABELS[i % 5],
            DRUGS[i % 4 if i % 3 else 4],
            RESULTS[i % 6],
            f"file_{i % 2}.csv",
            ("a", "b")[i % 2],
        )
        for i in [*range(600), *[8] * 400]
    ]
    text = COHORT_SCHEMA.add("source_file", "string").add("source_version", "string")
    return spark.createDataFrame(rows, text).withColumn("ingested_at", F.to_timestamp(F.lit("2025-04-11 06:00:00")))


@pytest.fixture(scope="module")
def plain(spark, raw):
    return ReportTables(raw, Seeds.built_in(spark))


def shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_one_shuffle_serves_every_grain(spark, raw, plain, rows):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        tables = ReportTables(raw, Seeds.built_in(spark), scratch=Scratch(spark), keep=("states",))
        assert {name: shuffles(getattr(tables, name)) for name in GRAINS} == dict.fromkeys(GRAINS, 0)
        assert shuffles(plain.records) > 5
        for name in GRAINS:
            columns = getattr(plain, name).columns
            assert rows(getattr(tables, name), *columns) == rows(getattr(plain, name), *columns), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_a_hot_key_are_folded_before_they_are_dealt(plain, rows):
    states = ("organism", "antibiotic", "susceptibility")

    def dealt(heavy_rows):
        return rollup.dealt_states(plain.staged, ORDER_KEYS, states, ("ingested_at",), "culture_key", "n", 5, heavy_rows)

    def dealing(frame):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange"), plan.count("Union")

    assert dealing(dealt(100_000)) == (1, 0) and dealing(dealt(100)) == (2, 1)
    assert rows(dealt(100)) == rows(dealt(100_000))
    assert dealt(100).agg(F.sum("n")).first()[0] == 1000


def test_buckets_grow_with_the_rows(spark, raw, plain, rows, monkeypatch):
    monkeypatch.setattr(storage, "BUCKET_ROWS", 70)
    monkeypatch.setattr(storage, "DEALT_ROWS", 50)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        tables = ReportTables(raw, Seeds.built_in(spark), scratch=Scratch(spark), keep=AUDIT_RELATIONS)
        for name in (*GRAINS, "group_endpoints"):
            frame = getattr(tables, name)
            assert shuffles(frame) == 0 and frame.groupBy("culture_key").count().rdd.getNumPartitions() == 15, name
            assert rows(frame, *getattr(plain, name).columns) == rows(getattr(plain, name), *getattr(plain, name).columns), name
        assert tables.for_window(tables.window).buckets == 15
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.conf.get(storage.SPLITS_SETTING, None) is None


def test_scans_to_deal_are_split_by_rows(spark, monkeypatch):
    monkeypatch.setattr(storage, "DEALT_ROWS", 1_000)
    monkeypatch.setattr(storage, "FILE_ROWS", 1_000)
    scratch = Scratch(spark)
    stored = scratch.keep("numbers", spark.range(40_000).repartition(1))
    assert len(stored.inputFiles()) == 40
    with scratch.splits_for(40_000):
        assert stored.select("id").rdd.getNumPartitions() >= 20


def test_lines_meet_their_orders_in_more_tasks_the_more_they_are(spark, rows, monkeypatch):
    def dealt():
        frame = source.raw_cohort(spark, "/root/testdata/sf0.001")
        return frame._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM"), rows(frame)

    few, raw_rows = dealt()
    monkeypatch.setattr(source, "PART_ROWS", 300)
    many, same = dealt()
    assert (few, many) == (0, 2) and same == raw_rows


@pytest.fixture
def star(spark, tmp_path):
    """4,000 lines in 40 files, 500 orders and 50 customers."""
    tables = {
        "customer": spark.range(50).selectExpr("id as c_custkey", "'BUILDING' as c_mktsegment", "id % 5 as c_nationkey"),
        "orders": spark.range(500).selectExpr(
            "id as o_orderkey", "id % 50 as o_custkey", "date_add(date'1998-01-01', cast(id % 300 as int)) as o_orderdate",
            "substr('FPO', cast(id % 3 as int) + 1, 1) as o_orderstatus", "if(id % 7 = 0, '5-LOW', '2-HIGH') as o_orderpriority",
        ),
        "lineitem": spark.range(4000).selectExpr(
            "id % 500 as l_orderkey", "id % 9 as l_suppkey", "(id % 10) / 100 as l_tax", "id % 50 as l_quantity",
            "substr('RNA', cast(id % 3 as int) + 1, 1) as l_returnflag", "substr('FO', cast(id % 2 as int) + 1, 1) as l_linestatus",
        ).repartition(40),
    }
    for name, frame in tables.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lines_meet_their_orders_in_tasks_of_bounded_rows_with_many_shuffle_partitions(spark, star, rows, monkeypatch):
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    few = rows(source.raw_cohort(spark, star))
    monkeypatch.setattr(source, "PART_ROWS", 100)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        frame = source.raw_cohort(spark, star)
        assert frame.rdd.getNumPartitions() >= 40
        assert rows(frame) == few and len(few) == 4000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_lines_are_dealt_from_scans_of_bounded_rows(spark, star, monkeypatch):
    monkeypatch.setattr(storage, "DEALT_ROWS", 100)
    tasks = {}

    def keep(scratch, name, frame, **rest):
        tasks[name] = source.table(spark, star, "lineitem").rdd.getNumPartitions()
        return frame

    monkeypatch.setattr(Scratch, "keep", keep)
    Context(spark, star).full
    assert tasks["raw_cohort"] >= 20
    assert spark.conf.get(storage.SPLITS_SETTING, None) is None
