import pytest
from pyspark.sql import functions as F

from cohortgram import reference as ref
from cohortgram.operators import consolidate, evidence, vocabulary
from cohortgram.sources.seeds import Seeds, small_table

S, R, I = "Susceptible", "Resistant", "Intermediate"


def phenotype(spark, label, results):
    """Classify one record with (drug, status, value) endpoints."""
    record = spark.createDataFrame([("r", label)], "culture_organism_key string, organism_source string")
    schema = "culture_organism_key string, organism_source string, antibiotic string, resolution_status string, susceptibility string"
    facts = spark.createDataFrame([("r", label, *x) for x in results], schema)
    labels = Seeds.built_in(spark).labels
    scoped = evidence.with_rule_scopes(vocabulary.map_labels(facts, labels))
    mapped = evidence.with_rule_scopes(vocabulary.map_labels(record, labels))
    return evidence.phenotype_records(mapped, evidence.evidence_counts(scoped))


def resolved(drug, value):
    return (drug, "resolved", value)


@pytest.mark.parametrize(
    "results, status",
    [
        ([resolved("Oxacillin", R), ("Cefoxitin", "conflict", None)], "positive"),
        ([resolved("Oxacillin", S), ("Cefoxitin", "conflict", None)], "not_evaluable"),
        ([resolved("Oxacillin", I)], "not_detected"),
        ([resolved("Oxacillin", "Inconclusive")], "not_evaluable"),
        ([resolved("Vancomycin", R)], "not_evaluable"),
        ([], "not_evaluable"),
    ],
)
def test_single_marker(spark, results, status):
    row = phenotype(spark, "STAPHYLOCOCCUS AUREUS", results).first()
    assert row.ast_oxacillin_resistance_status == status
    assert row.ast_cre_status == row.ast_vancomycin_resistance_status == "not_applicable"


@pytest.mark.parametrize(
    "label, drug, status",
    [
        ("ESCHERICHIA COLI", "Imipenem", "positive"),
        ("PROTEUS MIRABILIS", "Imipenem", "not_evaluable"),
        ("PROTEUS MIRABILIS", "Imipenem/Relebactam", "not_evaluable"),
        ("Proteus unheard of", "Meropenem", "positive"),
        ("zzzCitrobacter unheard of", "Ertapenem", "positive"),
        ("ZZZPROTEUS OLD", "Meropenem", "not_applicable"),
        ("CANDIDA ALBICANS", "Meropenem", "not_applicable"),
    ],
)
def test_carbapenem_scope(spark, label, drug, status):
    assert phenotype(spark, label, [resolved(drug, R)]).first().ast_cre_status == status


MDR_DRUGS = ["Cefepime", "Ciprofloxacin", "Tobramycin", "Meropenem", "Piperacillin/Tazobactam", "Cefiderocol"]


@pytest.mark.parametrize(
    "positive, negative, status",
    [(3, 0, "positive"), (2, 4, "not_detected"), (2, 3, "not_evaluable"), (0, 4, "not_detected"), (0, 3, "not_evaluable")],
)
def test_threshold_with_unknowns(spark, positive, negative, status):
    values = [I] * positive + [S] * negative
    row = phenotype(spark, "PSEUDOMONAS AERUGINOSA", [resolved(d, v) for d, v in zip(MDR_DRUGS, values)]).first()
    assert row.ast_mdr_p_aeruginosa_status == status
    assert row.mdr_positive_category_count == positive
    assert row.mdr_unknown_category_count == 6 - positive - negative


def test_category_statuses(spark):
    results = [resolved("Cefepime", S), resolved("Ceftazidime", R), ("Ciprofloxacin", "conflict", None), resolved("Tobramycin", S)]
    row = phenotype(spark, "PSEUDOMONAS AERUGINOSA", results).first()
    assert row.mdr_es_ceph_status == "positive"
    assert row.mdr_fq_status == "not_evaluable"
    assert row.mdr_aminoglycoside_status == "observed_non_positive"
    assert row.mdr_cefiderocol_status == "not_tested"


def test_source_designation_never_classifies(spark):
    row = phenotype(spark, "STAPH AUREUS {MRSA}", [resolved("Oxacillin", S)]).first()
    assert row.source_designated_mrsa and row.is_oxacillin_resistant is False


def test_priority_and_names(spark):
    results = [resolved("Meropenem", R), resolved("Ceftriaxone", R)]
    row = consolidate.categorised_records(phenotype(spark, "ESCHERICHIA COLI", results)).first()
    assert (row.reporting_phenotype, row.organism_name) == ("cre", "Escherichia coli")
    row = consolidate.categorised_records(phenotype(spark, "ESCHERICHIA COLI", results[1:])).first()
    assert row.reporting_phenotype == "esce_r"
    assert row.organism_name == "Escherichia coli — extended-spectrum cephalosporin resistant"


def test_label_map_defaults(spark):
    labels = small_table(
        spark,
        ref.LABEL_COLUMNS,
        [("A", "Aa", "  ", " ", 1, "reviewed", None), ("B", "Bb", "G", "q", 0, "reviewed", None)],
    )
    vocab = spark.createDataFrame([("A",), ("B",), ("C",)], "organism_source string")
    got = {r.organism_source: r for r in vocabulary.map_vocabulary(vocab, labels).collect()}
    assert got["A"].organism_reporting_group is None and got["A"].source_qualifier is None
    assert got["B"].include_primary_summary == 0
    assert (got["C"].mapping_status, got["C"].include_primary_summary, got["C"].has_reviewed_mapping) == ("unmapped", 0, False)


def test_cohort_lookup_is_exact(spark):
    frame = spark.createDataFrame([("BLOOD",), ("blood",), ("WOUND",), (None,)], "culture_description string")
    assert [r.cohort_id for r in vocabulary.assign_cohort(frame).collect()] == ["blood"]


def test_reference_tables_are_broadcast_by_size(spark):
    frame = spark.range(5).select(F.concat(F.lit("LABEL "), F.col("id")).alias("organism_source"))
    plan = vocabulary.map_labels(frame, Seeds.built_in(spark).labels)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan
