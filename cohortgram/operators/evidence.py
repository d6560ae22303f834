"""Evidence classification from a rule table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.measures import tally
from cohortgram.functions.statuses import NOT_APPLICABLE, NOT_DETECTED, NOT_EVALUABLE, POSITIVE, tri_state
from cohortgram.operators.reconcile import CONFLICT, RESOLVED
from cohortgram.reference import (
    BASE_PHENOTYPE,
    CATEGORISED,
    MARKER_DRUGS,
    RULES,
    SOURCE_DESIGNATIONS,
    SUSCEPTIBLE,
    Evidence,
    Rule,
    Scope,
)

OBSERVED_NON_POSITIVE, NOT_TESTED = "observed_non_positive", "not_tested"


def scope_column(rule: Rule) -> str:
    return f"{rule.name}_scope"


def in_scope(scope: Scope, label: str = "organism_source", standard: str = "organism_standardized") -> Column:
    """Standard names match exactly or by prefix; source labels by prefix in any case, mapped or not."""
    name, source = F.coalesce(F.col(standard), F.lit("")), F.upper(label)
    conditions = [name.startswith(prefix) for prefix in scope.standard_prefixes]
    conditions += [source.startswith(prefix) for prefix in scope.label_prefixes]
    if scope.standard_names:
        conditions.append(name.isin(*scope.standard_names))
    return reduce(lambda a, b: a | b, conditions)


def rule_scopes(rules: Sequence[Rule] = RULES, **columns: str) -> list[Column]:
    """Per rule the name of the first scope that holds, NULL when the rule does not apply."""
    return [
        reduce(lambda chain, s: chain.when(in_scope(s, **columns), s.name), rule.scopes, F).alias(scope_column(rule))
        for rule in rules
    ]


def with_rule_scopes(labels: DataFrame, rules: Sequence[Rule] = RULES, **columns: str) -> DataFrame:
    """Rows with a source label and its standard name, plus the scope columns."""
    return labels.select("*", *rule_scopes(rules, **columns))


def rule_drugs(rules: Sequence[Rule] = RULES) -> list[str]:
    return sorted({d for r in rules for e in r.evidence for drugs in e.drugs.values() for d in drugs})


_RESULT, _UNJUDGED = "_result", "unjudged"


def _counts(rule: Rule, evidence: Evidence) -> list[Column]:
    scope, drug, result = F.col(scope_column(rule)), F.col("antibiotic"), F.col(_RESULT)
    applies = reduce(
        lambda a, b: a | b, [(scope == name) & drug.isin(*drugs) for name, drugs in evidence.drugs.items()]
    )
    return [
        tally(applies & result.isin(*values)).alias(f"{evidence.name}_{kind}_count")
        for kind, values in (
            ("positive", evidence.positive),
            ("negative", evidence.negative),
            ("non_evaluable", (_UNJUDGED,)),
        )
    ]


def evidence_counts(
    endpoints: DataFrame, rules: Sequence[Rule] = RULES, keys: Sequence[str] = ("culture_organism_key",)
) -> DataFrame:
    """Positive, negative and non-evaluable endpoints per record and rule category, in one aggregation.

    ``endpoints`` carry the scope columns of ``rule_scopes``. Only endpoints inside a scope that are on some
    rule's drug list are aggregated; the drug list is an IN filter that reaches the file scan. Records
    without such endpoints have no row.
    """
    some_scope = reduce(lambda a, b: a | b, [F.col(scope_column(r)).isNotNull() for r in rules])
    value = F.col("susceptibility")
    judged = (F.col("resolution_status") == RESOLVED) & value.isin(*CATEGORISED)
    relevant = endpoints.filter(F.col("antibiotic").isin(*rule_drugs(rules)) & some_scope).withColumn(
        _RESULT, F.when(judged, value).otherwise(_UNJUDGED)
    )
    counts = [c for r in rules for e in r.evidence for c in _counts(r, e)]
    return relevant.groupBy(*keys).agg(*counts, *marker_flags())


MARKER_FLAGS = tuple(f"{drug.lower()}_{flag}" for drug in MARKER_DRUGS for flag in ("tested", "susceptible", "other"))


def marker_flags() -> list[Column]:
    """Aggregates, per marker drug: is there an endpoint, a susceptible one, one that is anything but that or missing."""
    status, susceptible = F.col("resolution_status"), F.col("susceptibility") == SUSCEPTIBLE
    flags = []
    for drug in MARKER_DRUGS:
        of = F.col("antibiotic") == drug
        resolved = of & (status == RESOLVED)
        flags += [
            F.max(of),
            F.max(F.coalesce(resolved & susceptible, F.lit(False))),
            F.max(F.coalesce(of & (status == CONFLICT), F.lit(False)) | F.coalesce(resolved & ~susceptible, F.lit(False))),
        ]
    return [flag.alias(name) for flag, name in zip(flags, MARKER_FLAGS)]


def _count(evidence: Evidence, kind: str) -> Column:
    return F.coalesce(F.col(f"{evidence.name}_{kind}_count"), F.lit(0))


def marker_status(applies: Column, positive: Column, non_evaluable: Column, negative: Column) -> Column:
    """Status of a rule that one positive endpoint satisfies; nothing tested is not evaluable."""
    return (
        F.when(~applies, NOT_APPLICABLE)
        .when(positive > 0, POSITIVE)
        .when(non_evaluable > 0, NOT_EVALUABLE)
        .when(negative > 0, NOT_DETECTED)
        .otherwise(NOT_EVALUABLE)
    )


def category_status(applies: Column, positive: Column, non_evaluable: Column, negative: Column) -> Column:
    """Status of one category of a k-of-n rule."""
    return (
        F.when(~applies, NOT_APPLICABLE)
        .when(positive > 0, POSITIVE)
        .when(non_evaluable > 0, NOT_EVALUABLE)
        .when(negative > 0, OBSERVED_NON_POSITIVE)
        .otherwise(NOT_TESTED)
    )


def k_of_n_status(applies: Column, positives: Column, unknowns: Column, needed: int) -> Column:
    """Positive at ``needed``; not detected only if the unknown categories could not reach it."""
    return (
        F.when(~applies, NOT_APPLICABLE)
        .when(positives >= needed, POSITIVE)
        .when(positives + unknowns < needed, NOT_DETECTED)
        .otherwise(NOT_EVALUABLE)
    )


def count_of(columns: Sequence[Column], *values: str) -> Column:
    return reduce(lambda a, b: a + b, [F.when(c.isin(*values), 1).otherwise(0) for c in columns])


def _applies(rule: Rule) -> Column:
    return F.col(scope_column(rule)).isNotNull()


def classify(records: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds category statuses, rule statuses and true/false/NULL flags to records with evidence counts.

    Each step is a projection of its own, so later ones read its columns instead of repeating its CASEs.
    """
    staged = [r for r in rules if r.needed is not None]
    judged = records.select(
        "*",
        *[
            category_status(
                _applies(r), _count(e, "positive"), _count(e, "non_evaluable"), _count(e, "negative")
            ).alias(f"{e.name}_status")
            for r in staged
            for e in r.evidence
        ],
    )
    counts = []
    for r in staged:
        categories = [F.col(f"{e.name}_status") for e in r.evidence]
        counts.append(count_of(categories, POSITIVE).alias(f"{r.name}_positive_category_count"))
        counts.append(count_of(categories, NOT_EVALUABLE, NOT_TESTED).alias(f"{r.name}_unknown_category_count"))
    judged = judged.select("*", *counts)

    def status(rule: Rule) -> Column:
        if rule.needed is not None:
            positives = F.col(f"{rule.name}_positive_category_count")
            unknowns = F.col(f"{rule.name}_unknown_category_count")
            return k_of_n_status(_applies(rule), positives, unknowns, rule.needed)
        (evidence,) = rule.evidence
        parts = [_count(evidence, kind) for kind in ("positive", "non_evaluable", "negative")]
        return marker_status(_applies(rule), *parts)

    judged = judged.select("*", *[status(r).alias(r.status) for r in rules])
    return judged.select("*", *[tri_state(r.status).alias(r.flag) for r in rules])


def source_designations(label: str = "organism_source", qualifier: str = "source_qualifier") -> list[Column]:
    """Resistance the source itself claims; kept for audit, never used to classify."""
    return [
        (
            (F.upper(F.coalesce(F.col(qualifier), F.lit(""))) == marker.upper())
            | F.upper(label).contains(fragment)
        ).alias(flag)
        for flag, marker, fragment in SOURCE_DESIGNATIONS
    ]


def phenotype_records(
    mapped: DataFrame,
    evidence: DataFrame,
    rules: Sequence[Rule] = RULES,
    keys: Sequence[str] = ("culture_organism_key",),
) -> DataFrame:
    """Mapped records with evidence, statuses, flags and source designations; the grain does not change."""
    judged = classify(mapped.join(evidence, list(keys), "left"), rules)
    return judged.select("*", *source_designations())


def priority_label(rules: Sequence[Rule] = RULES, base: str = BASE_PHENOTYPE) -> Column:
    """The reporting phenotype: the first positive rule in order of priority."""
    return reduce(lambda chain, r: chain.when(F.col(r.status) == POSITIVE, r.phenotype), rules, F).otherwise(base)


def display_name(group: str = "organism_reporting_group", rules: Sequence[Rule] = RULES) -> Column:
    """The group with the suffix of its first positive suffixed rule."""
    chain = F
    for rule in (r for r in rules if r.suffix):
        condition = F.col(rule.status) == POSITIVE
        if rule.plain_if_positive:
            condition &= F.col(rule.plain_if_positive) != POSITIVE
        chain = chain.when(condition, F.concat(F.col(group), F.lit(f" — {rule.suffix}")))
    return chain.otherwise(F.col(group))
