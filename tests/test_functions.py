import hashlib
from datetime import date, datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortgram.functions.cleaning import punctuation_free, safe_cast, sentinel_to_null
from cohortgram.functions.keys import NULL_TOKEN, packed, surrogate_key
from cohortgram.functions.measures import display_status, safe_pct
from cohortgram.functions.statuses import strongest_status, tri_state
from cohortgram.functions.windows import ReportWindow, add_months


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression).first()[0]


@pytest.mark.parametrize(
    "text, trimmed, raw",
    [("Null", None, None), (" Null ", None, "Null"), (" x ", "x", "x"), (None, None, None), ("null", "null", "null")],
)
def test_sentinel_order_of_trim_and_compare(spark, text, trimmed, raw):
    assert one(spark, text, sentinel_to_null("v")) == trimmed
    assert one(spark, text, sentinel_to_null("v", compare="raw")) == raw


def test_safe_cast_keeps_going(spark):
    assert one(spark, "1.0", safe_cast("v", "int")) is None
    assert one(spark, " 1 ", safe_cast("v", "int")) == 1
    assert one(spark, "2023-01-02 03:04:05", safe_cast("v", "timestamp")) == datetime(2023, 1, 2, 3, 4, 5)
    assert one(spark, "soon", safe_cast("v", "timestamp")) is None


def test_punctuation_free(spark):
    assert one(spark, " Imipenem/Relebactam ", punctuation_free("v")) == "imipenemrelebactam"


def test_surrogate_key_is_the_hash_of_its_parts(spark):
    frame = spark.createDataFrame([("a", None, 3)], "a string, b string, c int")
    key = frame.select(surrogate_key("a", "b", "c")).first()[0]
    assert key == hashlib.md5(f"a-{NULL_TOKEN}-3".encode()).hexdigest()


@pytest.mark.parametrize("part, whole, pct", [(1, 8, 12.5), (0, 5, 0.0), (0, 0, None), (3016, 3022, 99.8), (1, 16, 6.3)])
def test_safe_pct(spark, part, whole, pct):
    frame = spark.createDataFrame([(part, whole)], "a long, b long")
    assert frame.select(safe_pct("a", "b")).first()[0] == pct


def test_display_threshold(spark):
    frame = spark.createDataFrame([(29,), (30,)], "n long").select(display_status("n").alias("d"))
    assert [r.d for r in frame.collect()] == ["insufficient_data", "display"]


@pytest.mark.parametrize(
    "statuses, merged, flag",
    [
        (["not_detected", "positive", "not_evaluable"], "positive", True),
        (["not_detected", "not_evaluable"], "not_evaluable", None),
        (["not_applicable", "not_detected"], "not_detected", False),
        (["not_applicable"], "not_applicable", None),
        ([None], "not_applicable", None),
    ],
)
def test_status_precedence(spark, statuses, merged, flag):
    frame = spark.createDataFrame([(s,) for s in statuses], "s string")
    row = frame.agg(strongest_status("s").alias("m")).select("m", tri_state("m").alias("f")).first()
    assert (row.m, row.f) == (merged, flag)
    assert frame.agg(strongest_status("s", fallback=None)).first()[0] == (None if merged == "not_applicable" else merged)


def test_window_bounds(spark):
    window = ReportWindow(date(2023, 1, 1))
    times = [
        (datetime(2022, 12, 31, 23, 59),),
        (datetime(2023, 1, 1),),
        (datetime(2023, 12, 31, 23, 59),),
        (datetime(2024, 1, 1),),
        (None,),
    ]
    frame = spark.createDataFrame(times, "t timestamp")
    assert frame.filter(window.usable("t")).count() == 2
    assert frame.filter(ReportWindow().usable("t")).count() == 4
    assert frame.select(*window.columns()).first() == (date(2023, 1, 1), date(2024, 1, 1))
    assert frame.select(*ReportWindow().columns()).first() == (None, None)


def test_window_parse_and_month_end():
    assert ReportWindow.parse(" ") == ReportWindow.parse(None) == ReportWindow()
    assert ReportWindow.parse("2024-02-29").end == date(2025, 2, 28)


@given(st.dates(date(1900, 1, 1), date(2200, 1, 1)))
def test_add_months_keeps_the_month(day):
    end = add_months(day, 12)
    assert (end.year, end.month) == (day.year + 1, day.month) and day.day - end.day in (0, 1)


def test_window_filter_reaches_the_file_scan(spark, tmp_path):
    spark.range(10).select(F.timestamp_seconds("id").alias("t")).write.parquet(f"{tmp_path}/t")
    frame = spark.read.parquet(f"{tmp_path}/t").filter(ReportWindow(date(2023, 1, 1)).usable("t"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan and "LessThan(t," in plan


def test_packed_keys_are_equal_only_if_the_texts_are(spark):
    key = hashlib.md5(b"x").hexdigest()
    texts = [key, key.upper(), key[:-1], "0" + key[1:], "", "0", "00", "a", "0a", "A0", "a0", "\x00", "\x01\xa0", "é", " a0", "zz", "P1", None]
    frame = spark.createDataFrame([(t,) for t in texts], "v string").select("v", packed("v").alias("p"))
    found = {r.v: None if r.p is None else bytes(r.p) for r in frame.collect()}
    assert len(set(found.values())) == len(texts) and found[None] is None
    assert len(found[key]) == 17
