"""Wildcard rules by pattern give what one condition per rule gives, by equal keys alone."""

import random

import pytest
from pyspark.sql import functions as F

from cohortgram.operators import marts
from cohortgram.reference import WILDCARD

EQUAL, SCOPED = ("g", "d"), ("c", "p")


@pytest.fixture(scope="module")
def tables(spark):
    """Many rules on one drug, repeated rules, nulls on both sides, and a row that holds the wildcard as its value."""
    choose = random.Random(9)
    some = lambda *values: choose.choice([*values, None])
    cells = [(some("g1", "g2"), some("d1", "d2", "d3"), some(*"abcdefg", WILDCARD), some(*"uvwxyz", WILDCARD), i) for i in range(400)]
    rules = [("g1", "d1", choose.choice("abc"), f"q{i}") for i in range(500)]
    rules += [(some("g1", "g2"), some("d1", "d2"), some("a", "b", WILDCARD), some("u", "v", WILDCARD, "")) for _ in range(60)]
    rules += [("g2", "d3", WILDCARD, "w"), ("g2", "d3", WILDCARD, "w"), ("g2", "d3", "a", WILDCARD), ("g1", "d3", "a", "u")]
    return spark.createDataFrame(cells, "g string, d string, c string, p string, p_2 int"), spark.createDataFrame(
        rules, "g string, d string, c string, p string"
    )


def by_condition(cells, rules, how):
    own, rule = cells.alias("own"), rules.alias("rule")
    met = (F.col("own.g") == F.col("rule.g")) & (F.col("own.d") == F.col("rule.d"))
    for c in SCOPED:
        met &= (F.col(f"rule.{c}") == WILDCARD) | (F.col(f"rule.{c}") == F.col(f"own.{c}"))
    return own.join(rule, met, how)


@pytest.mark.parametrize("form, how", [(marts.wildcard_exclude, "left_anti"), (marts.wildcard_cover, "left_semi")])
def test_agrees_with_a_condition_per_rule(tables, form, how):
    cells, rules = tables
    got, expected = form(cells, rules, EQUAL, SCOPED), by_condition(cells, rules, how)
    assert got.columns == cells.columns
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, expected.collect())) and 20 < len(rows) < 380


@pytest.mark.parametrize("form", [marts.wildcard_exclude, marts.wildcard_cover])
def test_joins_have_equal_keys_and_no_condition(tables, form):
    plan = form(*tables, EQUAL, SCOPED)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 4 and not any(" OR " in line for line in joins)


def test_no_rules(tables):
    cells, rules = tables
    assert marts.wildcard_exclude(cells, rules.limit(0), EQUAL, SCOPED).count() == cells.count()
    assert marts.wildcard_cover(cells, rules.limit(0), EQUAL, SCOPED).count() == 0
