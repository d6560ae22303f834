"""Landed files have a bounded number of rows, however large a release is."""

from pyspark.sql import functions as F

from cohortgram.queries import source_queries
from cohortgram.queries.registry import load_all

SMALL = "/root/testdata/sf0.001"


def test_landed_files_are_bounded(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 8).select(F.col("id").cast("string").alias("text"))
    landed = f"{tmp_path}/landed"
    assert source_queries._land_half(rows, landed, 1000, 300) == 4
    found = spark.read.option("header", True).csv(landed).groupBy(F.input_file_name()).count().collect()
    assert len(found) == 4 and max(r["count"] for r in found) <= 300 and sum(r["count"] for r in found) == 1000


def test_an_empty_half_is_one_file(spark, tmp_path):
    nothing = spark.range(10).select(F.col("id").cast("string").alias("text")).where("false")
    assert source_queries._land_half(nothing, f"{tmp_path}/none", 0, 300) == 1
    assert len(list((tmp_path / "none").glob("*.csv"))) == 1


def test_more_files_load_the_same(spark, monkeypatch, rows):
    plain = rows(load_all()["ledger_load"].run(spark, SMALL))
    assert {r[3] for r in plain} == {2}
    monkeypatch.setattr(source_queries, "ROWS_PER_FILE", 1500)
    assert rows(load_all()["ledger_load"].run(spark, SMALL)) == plain
