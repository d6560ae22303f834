"""Audits of labels, mappings, drugs, policy, classification and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgram.functions.cleaning import punctuation_free
from cohortgram.functions.measures import n_rows, safe_pct, tally
from cohortgram.functions.statuses import NOT_APPLICABLE, NOT_DETECTED, NOT_EVALUABLE, POSITIVE
from cohortgram.functions.windows import ReportWindow
from cohortgram.operators import marts
from cohortgram.operators.evidence import (
    NOT_TESTED,
    OBSERVED_NON_POSITIVE,
    marker_status,
    priority_label,
)
from cohortgram.operators.profile import frequency, ranked_within, share_within
from cohortgram.operators.reconcile import CONFLICT, MISSING, RESOLVED
from cohortgram.operators.vocabulary import UNMAPPED, reporting_eligible
from cohortgram.reference import CATEGORISED, MDR, RESISTANT, RULES, WILDCARD, Rule
from cohortgram.sources.seeds import small_table

RECORD = "culture_organism_key"


def _categorised() -> Column:
    return (F.col("resolution_status") == RESOLVED) & F.col("susceptibility").isin(*CATEGORISED)


# -- labels and mappings ---------------------------------------------------------------------------
def labels_matching(records: DataFrame, label: str, fragments: Sequence[str]) -> DataFrame:
    """Labels with any of the fragments, which name a group, a complex or a variant."""
    some = reduce(lambda a, b: a | b, [F.col(label).contains(f) for f in fragments])
    return frequency(records.filter(some), [label], "record_count")


def unassigned_descriptions(cultures: DataFrame, known: Sequence[str]) -> DataFrame:
    return frequency(
        cultures.filter(~F.col("culture_description").isin(*known)), ["culture_description"], "culture_orders"
    )


def cohort_sizes(records: DataFrame) -> DataFrame:
    """Records, cultures, patients and labels per cohort."""
    return records.groupBy("cohort_id").agg(
        n_rows().alias("culture_organism_rows"),
        F.count_distinct("culture_key").alias("culture_orders"),
        F.count_distinct("patient_key").alias("patients"),
        F.count_distinct("organism").alias("source_organism_labels"),
    )


def mapping_coverage(mapped: DataFrame) -> DataFrame:
    reviewed = F.col("mapping_status") == "reviewed"
    # Labels repeat across records, so records are folded to labels before anything distinct is counted.
    labels = mapped.groupBy("cohort_id", "organism_source").agg(
        n_rows().alias("n"),
        F.max("mapping_status").alias("mapping_status"),
        F.max(F.when(F.col("include_primary_summary") == 1, F.col("organism_standardized"))).alias("primary_name"),
    )
    counted = labels.groupBy("cohort_id").agg(
        F.sum("n").alias("culture_organism_rows"),
        F.coalesce(F.sum(F.when(reviewed, F.col("n"))), F.lit(0)).alias("reviewed_mapping_rows"),
        n_rows().alias("source_organism_labels"),
        tally(reviewed).alias("reviewed_source_labels"),
        F.count_distinct("primary_name").alias("primary_standardized_organisms"),
    )
    return counted.withColumn("reviewed_mapping_pct", safe_pct("reviewed_mapping_rows", "culture_organism_rows"))


def unmapped_backlog(mapped: DataFrame) -> DataFrame:
    backlog = mapped.filter(F.col("mapping_status") == UNMAPPED)
    return frequency(backlog, ["cohort_id", "organism_source"], "culture_organism_rows", "patient_key")


def label_collisions(mapped: DataFrame) -> DataFrame:
    """Cultures on which several source labels share one standard name."""
    included = mapped.filter(F.col("include_primary_summary") == 1)
    keys = ("cohort_id", "culture_key", "organism_standardized")
    grouped = included.groupBy(*keys).agg(F.array_sort(F.collect_set("organism_source")).alias("source_labels"))
    return grouped.withColumn("source_label_count", F.size("source_labels").cast("long")).filter(
        "source_label_count > 1"
    )


def collisions_by_organism(collisions: DataFrame) -> DataFrame:
    return frequency(collisions, ["cohort_id", "organism_standardized"], "culture_orders_with_multiple_source_labels")


def incomplete_mappings(mapped: DataFrame) -> DataFrame:
    columns = ("organism_source", "organism_standardized", "include_primary_summary", "mapping_status")
    broken = (F.col("include_primary_summary") == 1) & F.col("organism_standardized").isNull()
    return mapped.filter(broken).groupBy(*columns).agg(n_rows().alias("record_count"))


def mapping_expectations(mapped: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected label mappings against the ones in use, with the first thing that differs."""
    attributes = ("organism_standardized", "organism_reporting_group", "source_qualifier", "mapping_status")
    actual = frequency(mapped, ["organism_source", *attributes], "culture_organism_records", "patient_key")
    wanted = expected.select(
        "organism_source",
        F.col("organism_standardized").alias("expected_standardized"),
        F.col("organism_reporting_group").alias("expected_reporting_group"),
        F.col("source_qualifier").alias("expected_source_qualifier"),
    )
    status = (
        F.when(F.col("mapping_status").isNull(), "missing_from_model")
        .when(F.col("organism_standardized") != F.col("expected_standardized"), "standardized_identity_mismatch")
        .when(F.col("organism_reporting_group") != F.col("expected_reporting_group"), "reporting_group_mismatch")
        .when(
            ~F.col("source_qualifier").eqNullSafe(F.col("expected_source_qualifier")), "source_qualifier_mismatch"
        )
        .when(F.col("mapping_status") != "reviewed", "mapping_status_mismatch")
        .otherwise("pass")
    )
    return wanted.join(actual, "organism_source", "left").withColumn("validation_status", status)


def reporting_status_audit(
    mapped: DataFrame, pairs: DataFrame, exclusions: DataFrame, minimum: int = 30
) -> DataFrame:
    """Frequent labels that reach no report, and why."""
    everywhere = exclusions.filter(F.col("reporting_phenotype") == WILDCARD)
    panels = (
        marts.wildcard_exclude(
            marts.active_pairs(pairs), everywhere, ("organism_reporting_group", "antibiotic"), ("cohort_id",)
        )
        .select("organism_reporting_group", "cohort_id")
        .distinct()
        .withColumn("_panel", F.lit(True))
    )
    per_patient = mapped.groupBy("cohort_id", "organism_source", "patient_key").agg(
        F.max("organism_reporting_group").alias("organism_reporting_group"),
        F.max("mapping_status").alias("mapping_status"),
        F.max("include_primary_summary").alias("include_primary_summary"),
        n_rows().alias("n"),
    )
    labels = per_patient.groupBy("cohort_id", "organism_source").agg(
        F.max("organism_reporting_group").alias("organism_reporting_group"),
        F.max("mapping_status").alias("mapping_status"),
        F.max("include_primary_summary").alias("include_primary_summary"),
        F.sum("n").alias("source_record_count"),
        F.count("patient_key").alias("unique_patients"),
    )
    not_approved = (F.col("mapping_status") != "reviewed") | (F.col("include_primary_summary") != 1)
    status = (
        F.when(not_approved, "unmapped_or_not_approved")
        .when(F.col("_panel").isNull(), "reviewed_no_antibiotic_panel")
        .otherwise("included")
    )
    audited = labels.join(panels, ["organism_reporting_group", "cohort_id"], "left").withColumn(
        "reporting_status", status
    )
    return audited.filter((F.col("source_record_count") >= minimum) & (F.col("reporting_status") != "included")).drop(
        "mapping_status", "include_primary_summary", "_panel"
    )


# -- drugs -----------------------------------------------------------------------------------------
def endpoint_facts(mapped: DataFrame, endpoints: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Endpoints with columns of the mapped record they belong to."""
    return endpoints.select(RECORD, "antibiotic", "resolution_status", "susceptibility").join(
        mapped.select(RECORD, *carry), RECORD
    )


def antibiotic_inventory(mapped: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Endpoints, records and patients per drug, over reportable records.

    An endpoint is unique per record and drug, so its count is the count of records.
    """
    facts = endpoint_facts(reporting_eligible(mapped), endpoints, ["patient_key"])
    counted = frequency(facts, ["antibiotic"], "endpoint_groups", "patient_key")
    return counted.withColumn("culture_organisms", F.col("endpoint_groups"))


def drug_coverage(records: DataFrame, endpoints: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group and drug: records, tested, categorised, conflicting and missing endpoints, coverage.

    Records are counted per group and endpoints per group and drug; records are not multiplied by drugs.
    """
    groups = frequency(records, list(by), "source_records", "patient_key").withColumnRenamed(
        "patients", "unique_patients"
    )
    facts = endpoint_facts(records, endpoints, by)
    drugs = facts.groupBy(*by, "antibiotic").agg(
        n_rows().alias("tested_records"),
        tally(_categorised()).alias("categorized_records"),
        tally(F.col("resolution_status") == CONFLICT).alias("conflict_records"),
        tally(F.col("resolution_status") == MISSING).alias("missing_records"),
    )
    return (
        drugs.join(groups, list(by))
        .withColumn("untested_records", F.col("source_records") - F.col("tested_records"))
        .withColumn("categorized_coverage_pct", safe_pct("categorized_records", "source_records"))
    )


def ranked_coverage(coverage: DataFrame, by: Sequence[str], top: int | None = None) -> DataFrame:
    ranked = ranked_within(coverage, by, [F.desc("categorized_records"), "antibiotic"], "antibiotic_rank")
    return ranked if top is None else ranked.filter(F.col("antibiotic_rank") <= top)


def label_variants(labels: DataFrame, label: str, normalised: Column, count: str) -> DataFrame:
    """Spellings that agree once normalised. ``labels`` is a vocabulary with counts."""
    grouped = labels.groupBy(normalised.alias("normalized_label")).agg(
        n_rows().alias("source_label_count"),
        F.array_sort(F.collect_set(label)).alias("source_labels"),
        F.sum(count).alias(count),
    )
    return grouped.filter("source_label_count > 1")


def drug_vocabulary(endpoints: DataFrame) -> DataFrame:
    return frequency(endpoints, ["antibiotic"], "endpoint_groups").select(
        "*", punctuation_free("antibiotic").alias("comparison_key")
    )


def rule_drug_table(spark: SparkSession, rules: Sequence[Rule] = RULES) -> DataFrame:
    rows = sorted({(r.name, d) for r in rules for e in r.evidence for drugs in e.drugs.values() for d in drugs})
    return small_table(spark, ("rule_name", "expected_antibiotic"), rows)


def rule_drug_status(vocabulary: DataFrame, rule_drugs: DataFrame) -> DataFrame:
    """Whether each drug of each rule is in the data under no, one or several labels."""
    expected = rule_drugs.withColumn("comparison_key", punctuation_free("expected_antibiotic"))
    matched = expected.join(vocabulary, "comparison_key", "left")
    labels = F.count("antibiotic")
    return matched.groupBy("rule_name", "expected_antibiotic").agg(
        labels.alias("matched_source_label_count"),
        F.array_sort(F.collect_set("antibiotic")).alias("matched_source_labels"),
        F.coalesce(F.sum("endpoint_groups"), F.lit(0)).alias("endpoint_groups"),
        F.when(labels == 0, "not_present")
        .when(labels == 1, "single_source_label")
        .otherwise("multiple_candidate_labels")
        .alias("vocabulary_status"),
    )


# -- policy ----------------------------------------------------------------------------------------
def policy_inventory(pairs: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Active pairs with the exclusions that touch them and the resulting decision."""
    active = marts.active_pairs(pairs)
    equal, scoped = ("organism_reporting_group", "antibiotic"), ("cohort_id",)
    shown = (F.col("reporting_phenotype").alias("excluded_reporting_phenotype"), "exclusion_reason", "review_basis")
    decision = F.when(F.col("excluded_reporting_phenotype") == WILDCARD, "excluded_all_categories").otherwise(
        "excluded_in_named_category"
    )
    parts = [marts.wildcard_exclude(active, exclusions, equal, scoped).withColumn("reporting_decision", F.lit("no_explicit_exclusion"))]
    for named, rules in marts.by_pattern(exclusions, scoped):
        touched = active.join(rules.select(*equal, *named, *shown), [*equal, *named])
        parts.append(touched.withColumn("reporting_decision", decision))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def pair_status(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Listed drugs by review status and inclusion, and further columns."""
    return frequency(pairs, ["review_status", "include_primary_dashboard", *by], "pair_rows")


def missing_attribute(reports: dict[str, DataFrame], attribute: str) -> DataFrame:
    """Rows and rows without the attribute, per report."""
    parts = [
        frame.agg(n_rows().alias("row_count"), tally(F.col(attribute).isNull()).alias(f"missing_{attribute}")).select(
            F.lit(name).alias("model_name"), "row_count", f"missing_{attribute}"
        )
        for name, frame in reports.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def exclusion_check(exclusions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rules, distinct rules and rules with a gap, over all rules or per value of ``by``."""
    required = ("organism_reporting_group", "cohort_id", "reporting_phenotype", "antibiotic")
    filled = (*required, "exclusion_reason", "review_basis")
    some_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in filled])
    return exclusions.groupBy(*by).agg(
        n_rows().alias("row_count"),
        F.count_distinct(F.concat_ws("||", *required)).alias("unique_rule_count"),
        tally(some_null).alias("null_required_fields"),
    )


# -- rule scopes and concordance -------------------------------------------------------------------
# Organism groups found from source labels alone, as (group, exact labels, label prefixes),
# first match wins.
CRE_LABEL_GROUPS = (
    ("Escherichia coli", (), ("ESCHERICHIA COLI",)),
    ("Klebsiella aerogenes", ("ZZZENTEROBACTER AEROGENES",), ("KLEBSIELLA AEROGENES",)),
    ("Klebsiella spp.", (), ("KLEBSIELLA ",)),
    ("Enterobacter spp.", (), ("ENTEROBACTER ",)),
    ("Citrobacter spp.", (), ("CITROBACTER ", "ZZZCITROBACTER ")),
    ("Serratia marcescens", (), ("SERRATIA MARCESCENS",)),
    ("Proteus spp.", (), ("PROTEUS ", "ZZZPROTEUS ")),
    ("Morganella morganii", ("MORGANELLA MORGANII",), ()),
)
ESCE_LABEL_GROUPS = (
    ("Escherichia coli", (), ("ESCHERICHIA COLI",)),
    ("Klebsiella aerogenes", ("ZZZENTEROBACTER AEROGENES",), ("ENTEROBACTER AEROGENES", "KLEBSIELLA AEROGENES")),
    ("Klebsiella oxytoca", (), ("KLEBSIELLA OXYTOCA",)),
    ("Klebsiella pneumoniae", (), ("KLEBSIELLA PNEUMONIAE",)),
    ("Enterobacter spp.", (), ("ENTEROBACTER ",)),
)
WITHOUT_IMIPENEM = ("Proteus spp.", "Morganella morganii")
MDR_TEXT = ("MDR", "MULTI%DRUG", "MULTIDRUG")
ESBL_TEXT = ("ESBL", "EXTENDED%SPECTRUM%BETA%LACTAMASE", "EXTENDED%SPECTRUM%B-LACTAMASE")


def label_group(label: str, groups: Sequence[tuple]) -> Column:
    def matches(exact, prefixes):
        return reduce(
            lambda a, b: a | b,
            [F.col(label) == e for e in exact] + [F.col(label).startswith(p) for p in prefixes],
        )

    return reduce(lambda chain, g: chain.when(matches(g[1], g[2]), g[0]), groups, F)


def label_mentions(columns: Sequence[str], fragments: Sequence[str]) -> Column:
    """Any column holds any fragment, in any case; ``%`` in a fragment stands for any text."""
    return reduce(
        lambda a, b: a | b,
        [F.upper(F.coalesce(F.col(c), F.lit(""))).like(f"%{f}%") for c in columns for f in fragments],
    )


def scope_discovery(mapped: DataFrame, groups: Sequence[tuple] = CRE_LABEL_GROUPS) -> DataFrame:
    """Labels a rule could cover, by cohort and discovered group."""
    found = mapped.withColumn("rule_group", label_group("organism_source", groups)).filter("rule_group is not null")
    return frequency(found, ["cohort_id", "rule_group", "organism_source"], "culture_organism_rows", "patient_key")


def unmapped_scope(mapped: DataFrame, groups: Sequence[tuple] = CRE_LABEL_GROUPS) -> DataFrame:
    """Labels a rule could cover that have no mapping yet."""
    labels = (
        mapped.filter(F.col("mapping_status") == UNMAPPED)
        .select("organism_source", label_group("organism_source", groups).alias("rule_group"))
        .filter("rule_group is not null")
        .distinct()
    )
    claimed = F.when(F.col("organism_source").contains("(CARBAPENEM RESISTANT)"), F.col("organism_source"))
    return labels.groupBy("rule_group").agg(
        F.when(F.col("rule_group").isin(*WITHOUT_IMIPENEM), 1).otherwise(0).alias("exclude_imipenem_from_cre_rule"),
        n_rows().alias("unmapped_source_label_count"),
        F.array_sort(F.collect_set("organism_source")).alias("unmapped_source_labels"),
        F.array_sort(F.collect_set(claimed)).alias("source_designated_cre_labels"),
    )


def label_summary(mapped: DataFrame, where: Column, attributes: Sequence[str]) -> DataFrame:
    """Records, patients and cohorts of the labels that satisfy a condition."""
    per_patient = (
        mapped.filter(where)
        .groupBy("organism_source", *attributes, "cohort_id", "patient_key")
        .agg(n_rows().alias("n"))
    )
    return per_patient.groupBy("organism_source", *attributes).agg(
        F.sum("n").alias("culture_organism_records"),
        F.count_distinct("patient_key").alias("patients"),
        F.array_sort(F.collect_set("cohort_id")).alias("cohorts"),
    )


def rule_evidence(
    records: DataFrame, endpoints: DataFrame, drugs: Column, absent: str | None = None
) -> DataFrame:
    """Records with counts, result pattern and status of one single-marker rule.

    ``drugs`` is an array column: the drugs that count for the record. Endpoints are folded per record
    before the left join, so records keep their grain; ``absent`` names a record without endpoints.
    """
    considered = records.select(RECORD, drugs.alias("_drugs"))
    facts = endpoints.select(RECORD, "antibiotic", "resolution_status", "susceptibility").join(considered, RECORD)
    facts = facts.filter(F.array_contains("_drugs", F.col("antibiotic")))
    result = F.concat(
        "antibiotic", F.lit("="), F.coalesce(F.col("susceptibility"), F.upper(F.col("resolution_status")))
    )
    resistant = _categorised() & (F.col("susceptibility") == RESISTANT)
    folded = facts.groupBy(RECORD).agg(
        n_rows().alias("qualifying_endpoint_count"),
        tally(_categorised()).alias("evaluable_endpoint_count"),
        tally(resistant).alias("resistant_endpoint_count"),
        # The rule's drug list bounds this set.
        F.concat_ws(", ", F.array_sort(F.collect_set(result))).alias("result_pattern"),
    )
    joined = records.join(folded, RECORD, "left").fillna(
        0, ["qualifying_endpoint_count", "evaluable_endpoint_count", "resistant_endpoint_count"]
    )
    counted = joined.select(
        *records.columns,
        "qualifying_endpoint_count",
        "evaluable_endpoint_count",
        "resistant_endpoint_count",
        (F.col("evaluable_endpoint_count") - F.col("resistant_endpoint_count")).alias("non_resistant_endpoint_count"),
        (F.col("qualifying_endpoint_count") - F.col("evaluable_endpoint_count")).alias("non_evaluable_endpoint_count"),
        F.coalesce("result_pattern", F.lit(absent or "")).alias("result_pattern"),
    )
    status = marker_status(
        F.lit(True),
        F.col("resistant_endpoint_count"),
        F.col("non_evaluable_endpoint_count"),
        F.col("non_resistant_endpoint_count"),
    )
    return counted.withColumn("ast_status", status)


def concordance_class(designated: Column, status: Column) -> Column:
    """The six ways a source designation and a derived status can meet."""
    return (
        F.when(designated & (status == POSITIVE), "concordant_positive")
        .when(designated & (status == NOT_DETECTED), "source_positive_ast_not_detected")
        .when(designated & (status == NOT_EVALUABLE), "source_positive_not_evaluable")
        .when(~designated & (status == POSITIVE), "ast_positive_without_source_label")
        .when(~designated & (status == NOT_DETECTED), "no_source_label_ast_not_detected")
        .otherwise("no_source_label_not_evaluable")
    )


DISCORDANT = (
    "source_positive_ast_not_detected",
    "source_positive_not_evaluable",
    "ast_positive_without_source_label",
)


def with_concordance(evidence: DataFrame, designated: str) -> DataFrame:
    return evidence.withColumn("concordance_status", concordance_class(F.col(designated), F.col("ast_status")))


def concordance_summary(concordance: DataFrame, by: Sequence[str], designated: str) -> DataFrame:
    return concordance.groupBy(*by, "concordance_status").agg(
        n_rows().alias("culture_organism_records"),
        tally(F.col(designated)).alias("source_designated_records"),
        tally(F.col("ast_status") == POSITIVE).alias("ast_positive_records"),
    )


def discordant_detail(concordance: DataFrame, by: Sequence[str]) -> DataFrame:
    counts = (
        "qualifying_endpoint_count",
        "evaluable_endpoint_count",
        "non_resistant_endpoint_count",
        "non_evaluable_endpoint_count",
        "resistant_endpoint_count",
    )
    rows = concordance.filter(F.col("concordance_status").isin(*DISCORDANT))
    return frequency(
        rows, [*by, "ast_status", "concordance_status", *counts, "result_pattern"], "culture_organism_records"
    )


def endpoint_availability(
    records: DataFrame, endpoints: DataFrame, drugs: Sequence[str], by: Sequence[str], absent: str
) -> DataFrame:
    """Defining endpoints per group, with a row for records that have none."""
    defining = endpoints.filter(F.col("antibiotic").isin(*drugs)).select(
        RECORD, "antibiotic", "resolution_status", "susceptibility"
    )
    joined = records.join(defining, RECORD, "left").select(
        *by,
        RECORD,
        "patient_key",
        F.coalesce("antibiotic", F.lit(absent)).alias("defining_antibiotic"),
        F.coalesce("resolution_status", F.lit("not_present")).alias("resolution_status"),
        F.coalesce("susceptibility", F.lit("[null]")).alias("susceptibility"),
    )
    return frequency(
        joined,
        [*by, "defining_antibiotic", "resolution_status", "susceptibility"],
        "culture_organism_records",
        "patient_key",
    )


def category_coverage(phenotypes: DataFrame, by: Sequence[str], rule: Rule = MDR) -> DataFrame:
    """Records per group and category status of a k-of-n rule.

    The dense record × category table is an unpivot of the category columns each record already has.
    """
    in_rule = phenotypes.filter(F.col(rule.status) != NOT_APPLICABLE)
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("category_order"),
                F.lit(e.name).alias("category"),
                F.col(f"{e.name}_status").alias("category_status"),
            )
            for i, e in enumerate(rule.evidence, start=1)
        ]
    )
    long = in_rule.select(*by, "patient_key", F.inline(cells))
    status = F.col("category_status")
    per_patient = long.groupBy(*by, "category_order", "category", "patient_key").agg(
        n_rows().alias("n"),
        tally(status != NOT_TESTED).alias("tested"),
        tally(status == POSITIVE).alias("positive"),
        tally(status == OBSERVED_NON_POSITIVE).alias("non_positive"),
        tally(status == NOT_EVALUABLE).alias("not_evaluable"),
    )
    summed = per_patient.groupBy(*by, "category_order", "category").agg(
        F.sum("n").alias("culture_organism_records"),
        F.count("patient_key").alias("patients"),
        F.sum("tested").alias("category_tested_records"),
        F.sum("positive").alias("category_positive_records"),
        F.sum("non_positive").alias("category_observed_non_positive_records"),
        F.sum("not_evaluable").alias("category_not_evaluable_records"),
        (F.sum("n") - F.sum("tested")).alias("category_not_tested_records"),
    )
    return summed.withColumn(
        "category_testing_coverage_pct", safe_pct("category_tested_records", "culture_organism_records")
    )


def threshold_bounds(phenotypes: DataFrame, by: Sequence[str], rule: Rule = MDR) -> DataFrame:
    """Records by positive, unknown and largest possible number of categories, with the status that follows."""
    in_rule = phenotypes.filter(F.col(rule.status) != NOT_APPLICABLE)
    positives, unknowns = F.col(f"{rule.name}_positive_category_count"), F.col(f"{rule.name}_unknown_category_count")
    shaped = in_rule.select(
        *by,
        "patient_key",
        F.col(rule.status).alias("ast_status"),
        positives.alias("positive_category_count"),
        (F.lit(len(rule.evidence)) - positives - unknowns).alias("observed_non_positive_category_count"),
        unknowns.alias("unknown_category_count"),
        (positives + unknowns).alias("maximum_possible_positive_category_count"),
    )
    keys = [c for c in shaped.columns if c != "patient_key"]
    return frequency(shaped, keys, "culture_organism_records", "patient_key")


def rule_drug_coverage(
    records: DataFrame, endpoints: DataFrame, drugs: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Per group and rule drug, tested or not: how records stand.

    Group totals, not records, are spread over the drug list; endpoints are counted apart and attached.
    """
    drug_list = F.array(
        *[F.struct(F.lit(i).alias("antibiotic_order"), F.lit(d).alias("antibiotic")) for i, d in enumerate(drugs, 1)]
    )
    totals = frequency(records, list(by), "culture_organism_records", "patient_key")
    grid = totals.withColumn("_drugs", drug_list).select("*", F.inline("_drugs")).drop("_drugs")
    facts = endpoint_facts(records, endpoints.filter(F.col("antibiotic").isin(*drugs)), by)
    resistant = _categorised() & (F.col("susceptibility") == RESISTANT)
    counted = facts.groupBy(*by, "antibiotic").agg(
        n_rows().alias("tested"), tally(_categorised()).alias("evaluable"), tally(resistant).alias("resistant")
    )
    on = reduce(
        lambda a, b: a & b, [F.col(f"g.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*by, "antibiotic")]
    )
    joined = grid.alias("g").join(counted.alias("c"), on, "left").select(
        "g.*",
        *[F.coalesce(F.col(f"c.{c}"), F.lit(0)).alias(c) for c in ("tested", "evaluable", "resistant")],
    )
    return joined.select(
        *by,
        "antibiotic_order",
        "antibiotic",
        "culture_organism_records",
        "patients",
        F.col("tested").alias("tested_endpoint_records"),
        F.col("evaluable").alias("evaluable_endpoint_records"),
        F.col("resistant").alias("resistant_records"),
        (F.col("evaluable") - F.col("resistant")).alias("observed_non_resistant_records"),
        (F.col("tested") - F.col("evaluable")).alias("not_evaluable_records"),
        (F.col("culture_organism_records") - F.col("tested")).alias("not_tested_records"),
        safe_pct("tested", "culture_organism_records").alias("testing_coverage_pct"),
        safe_pct("evaluable", "culture_organism_records").alias("evaluable_coverage_pct"),
    )


def status_share(evidence: DataFrame, by: Sequence[str], within: Sequence[str]) -> DataFrame:
    counted = frequency(evidence, [*by, "ast_status"], "culture_organism_records", "patient_key")
    return share_within(counted, "culture_organism_records", within, "pct_within_group")


# -- classification --------------------------------------------------------------------------------
def status_distribution(phenotypes: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Records per rule and status, from one scan."""
    long = marts.status_long(phenotypes, [(r, r.name) for r in rules], [], "phenotype", "status")
    return frequency(long, ["phenotype", "status"], "records")


def category_rollup(records: DataFrame) -> DataFrame:
    return records.groupBy("reporting_phenotype").agg(
        n_rows().alias("reporting_records"),
        tally(F.col("source_organism_record_count") > 1).alias("multi_source_records"),
        F.max("source_organism_record_count").alias("max_source_records_per_reporting_record"),
    )


def precedence_reassignment(phenotypes: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Of the positives of each rule, how many keep their category, leave the report, or fall to a stronger rule."""
    reportable = (
        (F.col("include_primary_summary") == 1)
        & (F.col("mapping_status") == "reviewed")
        & F.col("organism_reporting_group").isNotNull()
    )
    category = F.when(~reportable, "excluded").otherwise(priority_label(rules))
    cells = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule_name"),
                F.lit(r.phenotype).alias("own_category"),
                F.col(r.status).alias("status"),
            )
            for r in rules
        ]
    )
    positives = phenotypes.select(category.alias("category"), F.inline(cells)).filter(F.col("status") == POSITIVE)
    kept = F.col("category") == F.col("own_category")
    excluded = F.col("category") == "excluded"
    return positives.groupBy("rule_name").agg(
        n_rows().alias("source_records"),
        tally(kept).alias("retained_in_category"),
        tally(excluded).alias("excluded_from_reporting_layer"),
        tally(~kept & ~excluded).alias("reassigned_by_precedence"),
    )


# -- selections ------------------------------------------------------------------------------------
def selection_grain(overall: DataFrame) -> DataFrame:
    """Keys, duplicates and missing members of the overall selection."""
    per_key = overall.groupBy("overall_reporting_isolate_key").agg(
        n_rows().alias("n"),
        tally(F.col("source_culture_organism_keys").isNull() | (F.size("source_culture_organism_keys") == 0)).alias(
            "missing"
        ),
    )
    return per_key.agg(
        F.sum("n").alias("overall_records"),
        n_rows().alias("unique_overall_keys"),
        (F.sum("n") - n_rows()).alias("duplicate_keys"),
        F.sum("missing").alias("records_missing_source_keys"),
    )


def overall_rebuild(observations: DataFrame, overall: DataFrame) -> DataFrame:
    """Selections compared with the smallest (time, culture) per patient, found by aggregation."""
    keys = ["source_version", "cohort_id", "patient_key", "organism_reporting_group"]
    first = F.min(F.struct("culture_time_shifted", "culture_key"))["culture_key"]
    expected = observations.groupBy(*keys).agg(first.alias("expected_culture"))
    actual = overall.select(*keys, F.col("culture_key").alias("selected_culture"))
    both = expected.join(actual, keys, "full")
    same = F.col("expected_culture").eqNullSafe(F.col("selected_culture"))
    return both.agg(n_rows().alias("compared_groups"), tally(~same).alias("selection_mismatches"))


def member_rebuild(overall: DataFrame, records: DataFrame) -> DataFrame:
    """Member arrays of the selection compared with a rebuild from the records."""
    keys = ["source_version", "cohort_id", "patient_key", "organism_reporting_group", "culture_key"]
    members = (
        overall.select("overall_reporting_isolate_key", *keys)
        .join(records.select(*keys, "reporting_culture_organism_key", "source_culture_organism_keys"), keys)
        .groupBy("overall_reporting_isolate_key")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_culture_organism_keys")))).alias("_members"),
            F.count_distinct("reporting_culture_organism_key").alias("_records"),
        )
    )
    compared = overall.join(members, "overall_reporting_isolate_key", "left")
    return compared.agg(
        n_rows().alias("selected_cultures_compared"),
        tally(~F.col("source_culture_organism_keys").eqNullSafe(F.col("_members"))).alias("source_key_array_mismatches"),
        tally(~F.col("phenotype_records_on_culture").eqNullSafe(F.col("_records"))).alias(
            "phenotype_record_count_mismatches"
        ),
    )


def endpoint_consistency(endpoints: DataFrame, key: str) -> DataFrame:
    resolved = F.col("resolution_status") == RESOLVED
    per_key = endpoints.groupBy(key).agg(
        n_rows().alias("n"),
        tally(resolved & F.col("susceptibility").isNull()).alias("a"),
        tally(~resolved & F.col("susceptibility").isNotNull()).alias("b"),
    )
    return per_key.agg(
        F.sum("n").alias("endpoint_rows"),
        n_rows().alias("unique_keys"),
        F.sum("a").alias("resolved_with_null"),
        F.sum("b").alias("unresolved_with_result"),
    )


def reason_counts(endpoints: DataFrame) -> DataFrame:
    return endpoints.groupBy("resolution_status", "reconciliation_reason").agg(
        n_rows().alias("endpoint_rows"),
        tally(F.col("source_organisms_with_endpoint") > 1).alias("multi_source_endpoints"),
    )


def scope_inspection(group_endpoints: DataFrame) -> DataFrame:
    per_source = group_endpoints.groupBy("ast_scope", "reporting_source_key").agg(
        n_rows().alias("n"), tally(F.col("resolution_status") == CONFLICT).alias("conflicts")
    )
    return per_source.groupBy("ast_scope").agg(
        F.sum("n").alias("endpoint_rows"),
        n_rows().alias("culture_groups"),
        F.sum("conflicts").alias("conflicting_endpoints"),
    )


# -- reports ---------------------------------------------------------------------------------------
WINDOW_COLUMNS = ("analysis_window_start", "analysis_window_end_exclusive")


def display_coverage(mart: DataFrame, by: Sequence[str]) -> DataFrame:
    displayed = F.col("display_status") == "display"
    counted = mart.groupBy(*by).agg(
        n_rows().alias("total_pairs"),
        tally(displayed).alias("displayable_pairs"),
        tally(~displayed).alias("insufficient_data_pairs"),
    )
    return counted.withColumn("pct_displayable", safe_pct("displayable_pairs", "total_pairs"))


def mart_inventory(mart: DataFrame) -> DataFrame:
    """Groups and rows per category, by window."""
    per_group = mart.groupBy(*WINDOW_COLUMNS, "reporting_phenotype", "organism_reporting_group").agg(
        n_rows().alias("n"), tally(F.col("display_status") == "display").alias("d")
    )
    return per_group.groupBy(*WINDOW_COLUMNS, "reporting_phenotype").agg(
        n_rows().alias("organism_count"),
        F.sum("n").alias("mart_rows"),
        F.sum("d").alias("displayable_rows"),
        (F.sum("n") - F.sum("d")).alias("insufficient_data_rows"),
    )


def mart_structure(mart: DataFrame) -> DataFrame:
    """Key, attribute and identity problems of the susceptibility table in one row."""
    c = F.col
    parts = (
        c("categorized_count")
        + c("inconclusive_count")
        + c("synergism_count")
        + c("missing_result_count")
        + c("conflict_result_count")
    )
    return mart.agg(
        n_rows().alias("mart_rows"),
        F.count_distinct("susceptibility_mart_key").alias("unique_keys"),
        tally(c("gram_stain_group").isNull()).alias("missing_gram_group"),
        tally((c("eligible_count") < 0) | (c("categorized_count") < 0) | (c("untested_count") < 0)).alias(
            "negative_count_rows"
        ),
        tally(c("eligible_count") != parts + c("untested_count")).alias("denominator_mismatches"),
        tally(c("tested_endpoint_count") + c("untested_count") != c("eligible_count")).alias("tested_mismatches"),
        tally(c("tested_endpoint_count") != parts).alias("status_mismatches"),
        tally(
            c("categorized_count") != c("susceptible_count") + c("resistant_count") + c("intermediate_count")
        ).alias("category_mismatches"),
        tally(
            (c("categorized_count") > c("eligible_count"))
            | (c("susceptible_count") > c("categorized_count"))
            | (c("resistant_count") > c("categorized_count"))
            | (c("intermediate_count") > c("categorized_count"))
        ).alias("bound_violations"),
    )


def threshold_violations(mart: DataFrame, minimum: int = 30) -> DataFrame:
    wanted = F.when(F.col("categorized_count") >= minimum, "display").otherwise("insufficient_data")
    return mart.filter(F.col("display_status") != wanted)


def attribute_mismatches(mart: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    reference = groups.select(
        F.col("organism_reporting_group").alias(key), F.col("gram_stain_group").alias("reference_group")
    )
    return mart.join(reference, key, "left").filter(
        F.col("gram_stain_group").isNull() | ~F.col("gram_stain_group").eqNullSafe(F.col("reference_group"))
    )


def gram_breakdown(mart: DataFrame, group: str, by: Sequence[str] = ("gram_stain_group",)) -> DataFrame:
    return mart.groupBy(*by).agg(F.count_distinct(group).alias("organism_count"), n_rows().alias("mart_rows"))


def panel_preview(mart: DataFrame, cohort: str) -> DataFrame:
    """One cohort's table in report order."""
    return mart.filter(F.col("cohort_id") == cohort).orderBy(
        "source_version", "organism_reporting_group", "reporting_phenotype", "pair_order"
    )


def mdro_structure(mart: DataFrame) -> DataFrame:
    c = F.col
    bad_counts = (c("denominator_count") != c("positive_count") + c("not_detected_count") + c("not_evaluable_count")) | (
        c("evaluable_count") != c("positive_count") + c("not_detected_count")
    )
    bad_pct = ~c("phenotype_pct").eqNullSafe(safe_pct("positive_count", "denominator_count")) | ~c(
        "evaluable_pct"
    ).eqNullSafe(safe_pct("evaluable_count", "denominator_count"))
    return mart.agg(
        n_rows().alias("mart_rows"),
        F.count_distinct("mdro_mart_key").alias("unique_keys"),
        tally(bad_counts).alias("count_identity_mismatches"),
        tally(
            (c("positive_count") < 0)
            | (c("not_detected_count") < 0)
            | (c("not_evaluable_count") < 0)
            | (c("positive_count") > c("denominator_count"))
        ).alias("invalid_counts"),
        tally(bad_pct).alias("percentage_formula_mismatches"),
        tally(~c("phenotype_pct").between(0, 100) | ~c("evaluable_pct").between(0, 100)).alias(
            "out_of_bounds_percentages"
        ),
        tally(c("gram_stain_group").isNull()).alias("missing_gram_classification"),
    )


def mdro_rebuild(mart: DataFrame, records: DataFrame) -> DataFrame:
    """The resistance table rebuilt inside the window it records.

    The window comes from the table itself, as scalar subqueries. More than one window, or half of one, is
    reported as an invalid window instead of a pass.
    """
    start, end = WINDOW_COLUMNS
    recorded = mart.agg(
        F.count_distinct(F.struct(start, end)).alias("window_count"),
        F.min(start).alias(start),
        F.min(end).alias(end),
        n_rows().alias("mdro_mart_rows"),
    )
    whole = F.col(start).isNull() & F.col(end).isNull()
    bounded = F.coalesce(F.col(start) < F.col(end), F.lit(False))
    checked = recorded.withColumn("valid", (F.col("window_count") == 1) & (whole | bounded))
    valid, first, last = (checked.select(c).scalar() for c in ("valid", start, end))
    time = F.col("culture_time_shifted")
    inside = records.filter(time.isNotNull() & valid & (first.isNull() | (time >= first)) & (last.isNull() | (time < last)))
    patients = marts.patient_status(inside, ReportWindow()).withColumnRenamed(
        "organism_reporting_group", "organism_base_name"
    )
    keys = ["source_version", "cohort_id", "organism_base_name", "mdro_phenotype"]
    counts = ("denominator_count", "positive_count", "not_detected_count", "not_evaluable_count")
    expected = marts.status_summary(patients, keys).select(*keys, *[F.col(c).alias(f"expected_{c}") for c in counts])
    both = expected.join(mart.select(*keys, *counts), keys, "full").filter(valid)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"expected_{c}")) for c in counts])
    result = both.withColumn("validation_status", F.when(same, "pass").otherwise("mismatch"))
    passed = frequency(result, ["validation_status"], "mdro_mart_rows").select(
        first.alias(start), last.alias(end), "validation_status", "mdro_mart_rows"
    )
    invalid = checked.filter("not valid").select(
        start, end, F.lit("invalid_reporting_window").alias("validation_status"), "mdro_mart_rows"
    )
    return passed.unionByName(invalid)


def mdro_totals(mart: DataFrame) -> DataFrame:
    return mart.groupBy("mdro_phenotype", "cohort_id").agg(
        n_rows().alias("rows"),
        F.sum("denominator_count").alias("patients"),
        F.sum("positive_count").alias("positive_patients"),
    )


def groups_without_reference(susceptibility: DataFrame, mdro: DataFrame, groups: DataFrame) -> DataFrame:
    reported = (
        susceptibility.select("organism_reporting_group")
        .unionByName(mdro.select(F.col("organism_base_name").alias("organism_reporting_group")))
        .distinct()
    )
    return reported.join(groups.select("organism_reporting_group"), "organism_reporting_group", "left_anti")


def category_inventory(mart: DataFrame) -> DataFrame:
    return mart.groupBy("reporting_phenotype", "organism_reporting_group").agg(
        n_rows().alias("mart_rows"), F.max("eligible_count").alias("maximum_eligible_count")
    )


def category_sizes(mart: DataFrame, group: str) -> DataFrame:
    return (
        mart.filter(F.col("organism_reporting_group") == group)
        .groupBy("cohort_id", "reporting_phenotype")
        .agg(F.max("eligible_count").alias("n_first_cultures"))
    )


def population_overlap(stratified: DataFrame) -> DataFrame:
    """Patients in the base category and in a resistant one of the same group."""
    phenotype = F.col("reporting_phenotype")
    patients = stratified.groupBy("source_version", "cohort_id", "organism_reporting_group", "patient_key").agg(
        *[
            F.max(F.when(phenotype == p, 1).otherwise(0)).alias(name)
            for p, name in (("base", "base"), ("esce_r", "esce"), ("vancomycin_resistant", "vre"))
        ]
    )
    both = (F.col("base") == 1) & ((F.col("esce") == 1) | (F.col("vre") == 1))
    return (
        patients.groupBy("cohort_id", "organism_reporting_group")
        .agg(
            F.sum("base").alias("base_patients"),
            F.sum("esce").alias("esce_r_patients"),
            F.sum("vre").alias("vre_patients"),
            tally(both).alias("patients_in_both_categories"),
        )
        .filter("esce_r_patients + vre_patients > 0")
    )


# -- windows ---------------------------------------------------------------------------------------
def yearly_groups(records: DataFrame) -> DataFrame:
    """Patient-organism groups per year and cohort, and those with resistance evidence."""
    timed = records.filter("culture_time_shifted is not null")
    flags = (
        ("ast_esce_enterobacterales_status", "groups_with_esce_evidence"),
        ("ast_oxacillin_resistance_status", "groups_with_mrsa_evidence"),
        ("ast_vancomycin_resistance_status", "groups_with_vre_evidence"),
    )
    groups = timed.groupBy(
        F.year("culture_time_shifted").alias("shifted_year"), "cohort_id", "organism_reporting_group", "patient_key"
    ).agg(*[F.max(F.when(F.col(s) == POSITIVE, 1).otherwise(0)).alias(name) for s, name in flags])
    return groups.groupBy("shifted_year", "cohort_id").agg(
        n_rows().alias("patient_organism_groups"), *[F.sum(name).alias(name) for _, name in flags]
    )


def monthly_cultures(records: DataFrame, window: ReportWindow, cohorts: Sequence[str]) -> DataFrame:
    """Distinct cultures per month, one column per cohort."""
    month = F.date_format("culture_time_shifted", "yyyy-MM").alias("shifted_month")
    cultures = (
        records.filter(window.usable("culture_time_shifted")).select(month, "cohort_id", "culture_key").distinct()
    )
    return cultures.groupBy("shifted_month").agg(
        *[tally(F.col("cohort_id") == c).alias(f"{c}_cultures") for c in cohorts]
    )
