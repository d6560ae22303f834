"""Audits of mappings, drugs, policy, classification and the finished tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortgram import reference as ref
from cohortgram.functions.cleaning import punctuation_free
from cohortgram.operators import audits, bitmaps, marts, profile
from cohortgram.operators.vocabulary import reporting_eligible
from cohortgram.plans import Scratch
from cohortgram.queries.context import Context
from cohortgram.queries.registry import query
from cohortgram.queries.sql import CRE_GROUP, ESCE_GROUP, any_rows, in_list, like_any, pct, values
from cohortgram.sources.seeds import small_table

CATEGORISED = "resolution_status = 'resolved' AND susceptibility IN ('Susceptible', 'Intermediate', 'Resistant')"
LABEL = "cohort_id organism_source"
COUNTED = "culture_organism_records patients"
COUNTED_SQL = "count(*) AS culture_organism_records, count(DISTINCT patient_key) AS patients"


# -- mappings --------------------------------------------------------------------------------------
@query(
    "cohort_id culture_organism_rows reviewed_mapping_rows reviewed_mapping_pct source_organism_labels "
    "reviewed_source_labels primary_standardized_organisms",
    f"""SELECT cohort_id, count(*) AS culture_organism_rows, {any_rows("mapping_status = 'reviewed'")} AS
  reviewed_mapping_rows, {pct(any_rows("mapping_status = 'reviewed'"), 'count(*)')} AS reviewed_mapping_pct,
  count(DISTINCT organism_source) AS source_organism_labels,
  count(DISTINCT organism_source) FILTER (WHERE mapping_status = 'reviewed') AS reviewed_source_labels,
  count(DISTINCT organism_standardized) FILTER (WHERE include_primary_summary = 1) AS primary_standardized_organisms
FROM mapped GROUP BY 1""",
    "mapped",
)
def mapping_coverage(c: Context):
    return audits.mapping_coverage(c.full.mapped)


@query(
    f"{LABEL} culture_organism_rows patients",
    """SELECT cohort_id, organism_source, count(*) AS culture_organism_rows, count(DISTINCT patient_key) AS patients
FROM mapped WHERE mapping_status = 'unmapped' GROUP BY ALL""",
    "mapped",
)
def unmapped_backlog(c: Context):
    return audits.unmapped_backlog(c.full.mapped)


_COLLISIONS = """SELECT cohort_id, culture_key, organism_standardized, count(DISTINCT organism_source) AS
  source_label_count, array_to_string(list_sort(list(DISTINCT organism_source)), '|') AS source_labels
FROM mapped WHERE include_primary_summary = 1 GROUP BY ALL HAVING count(DISTINCT organism_source) > 1"""


@query(
    "cohort_id culture_key organism_standardized source_label_count #source_labels", _COLLISIONS, "mapped"
)
def label_collisions(c: Context):
    return audits.label_collisions(c.full.mapped)


@query(
    "cohort_id organism_standardized culture_orders_with_multiple_source_labels",
    f"""SELECT cohort_id, organism_standardized, count(*) AS culture_orders_with_multiple_source_labels
FROM ({_COLLISIONS}) GROUP BY ALL""",
    "mapped",
)
def collisions_by_organism(c: Context):
    return audits.collisions_by_organism(audits.label_collisions(c.full.mapped))


@query(
    "organism_source include_primary_summary mapping_status record_count",
    """SELECT organism_source, 1 AS include_primary_summary, 'draft' AS mapping_status, count(*) AS record_count
FROM mapped WHERE mapping_status = 'unmapped' GROUP BY 1""",
    "mapped",
)
def incomplete_mappings(c: Context):
    """Labels included before anyone gave them a standard name."""
    drafted = F.col("mapping_status") == "unmapped"
    mapped = c.full.mapped.withColumn(
        "include_primary_summary", F.when(drafted, 1).otherwise(F.col("include_primary_summary"))
    ).withColumn("mapping_status", F.when(drafted, "draft").otherwise(F.col("mapping_status")))
    return audits.incomplete_mappings(mapped)


@query(
    "organism_reporting_group records missing_gram_classification",
    """SELECT organism_reporting_group, count(*) AS records, count(*) FILTER (WHERE gram_stain_group IS NULL) AS
  missing_gram_classification FROM mapped LEFT JOIN groups USING (organism_reporting_group) GROUP BY 1""",
    "mapped",
    "groups",
)
def gram_reference(c: Context):
    key = "organism_reporting_group"
    joined = marts.attach_attribute(c.full.mapped, c.seeds.groups, key, key)
    return joined.groupBy(key).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("gram_stain_group").isNull()).alias("missing_gram_classification"),
    )


EXPECTED = [
    ("ZZZENTEROBACTER AEROGENES", "Klebsiella aerogenes", "Klebsiella aerogenes", None),
    ("CITROBACTER KOSERI", "Citrobacter koseri", "Citrobacter koseri", None),
    ("ENTEROBACTER CLOACAE COMPLEX", "Enterobacter cloacae", "Enterobacter cloacae complex", None),
    ("ESCHERICHIA COLI (CARBAPENEM RESISTANT)", "Escherichia coli", "Escherichia coli", None),
    ("SERRATIA MARCESCENS", "Serratia marcescens", "Serratia species", None),
    ("PROTEUS VULGARIS", "Proteus vulgaris", "Proteus vulgaris", None),
    ("CITROBACTER BRAAKII", "Citrobacter braakii", "Citrobacter freundii complex", None),
]
EXPECTED_COLUMNS = ("organism_source", "organism_standardized", "organism_reporting_group", "source_qualifier")


@query(
    "organism_source expected_standardized expected_reporting_group expected_source_qualifier organism_standardized "
    "mapping_status $culture_organism_records $patients validation_status",
    f"""SELECT e.organism_source, e.organism_standardized AS expected_standardized,
  e.organism_reporting_group AS expected_reporting_group, e.source_qualifier::varchar AS expected_source_qualifier,
  a.organism_standardized, a.mapping_status, n::varchar AS culture_organism_records, p::varchar AS patients,
  CASE WHEN a.organism_source IS NULL THEN 'missing_from_model'
    WHEN a.organism_standardized <> e.organism_standardized THEN 'standardized_identity_mismatch'
    WHEN a.organism_reporting_group <> e.organism_reporting_group THEN 'reporting_group_mismatch'
    WHEN a.source_qualifier IS DISTINCT FROM e.source_qualifier::varchar THEN 'source_qualifier_mismatch'
    WHEN a.mapping_status <> 'reviewed' THEN 'mapping_status_mismatch' ELSE 'pass' END AS validation_status
FROM ({values(', '.join(EXPECTED_COLUMNS), EXPECTED)}) e
LEFT JOIN (SELECT organism_source, organism_standardized, organism_reporting_group, source_qualifier, mapping_status,
    count(*) AS n, count(DISTINCT patient_key) AS p FROM mapped GROUP BY ALL) a USING (organism_source)""",
    "mapped",
)
def mapping_expectations(c: Context):
    return audits.mapping_expectations(c.full.mapped, small_table(c.spark, EXPECTED_COLUMNS, EXPECTED))


@query(
    "cohort_id organism_source organism_reporting_group source_record_count unique_patients reporting_status",
    """SELECT cohort_id, organism_source, organism_reporting_group, n AS source_record_count, p AS unique_patients,
  CASE WHEN mapping_status <> 'reviewed' THEN 'unmapped_or_not_approved' ELSE 'reviewed_no_antibiotic_panel' END
    AS reporting_status
FROM (SELECT cohort_id, organism_source, organism_reporting_group, mapping_status, count(*) AS n,
    count(DISTINCT patient_key) AS p FROM mapped GROUP BY ALL) m
WHERE n >= 30 AND (mapping_status <> 'reviewed' OR NOT EXISTS (SELECT 1 FROM active a
  WHERE a.organism_reporting_group = m.organism_reporting_group AND a.cohort_id = m.cohort_id
    AND NOT EXISTS (SELECT 1 FROM exclusions e WHERE e.organism_reporting_group = a.organism_reporting_group
      AND e.antibiotic = a.antibiotic AND e.cohort_id IN ('*', a.cohort_id) AND e.reporting_phenotype = '*')))""",
    "mapped",
    "active",
    "exclusions",
)
def reporting_status_audit(c: Context):
    return audits.reporting_status_audit(c.full.mapped, c.seeds.pairs, c.seeds.exclusions)


# -- drugs -----------------------------------------------------------------------------------------
_COVERAGE = f"""SELECT g.cohort_id, g.organism_source, antibiotic, source_records, unique_patients, tested_records,
  categorized_records, conflict_records, missing_records, source_records - tested_records AS untested_records,
  {pct('categorized_records', 'source_records')} AS categorized_coverage_pct
FROM (SELECT cohort_id, organism_source, count(*) AS source_records, count(DISTINCT patient_key) AS unique_patients
  FROM mapped GROUP BY ALL) g
JOIN (SELECT cohort_id, organism_source, antibiotic, count(*) AS tested_records,
    {any_rows(CATEGORISED)} AS categorized_records, {any_rows("resolution_status = 'conflict'")} AS conflict_records,
    {any_rows("resolution_status = 'missing'")} AS missing_records
  FROM mapped JOIN endpoint USING (culture_organism_key) GROUP BY ALL) d USING (cohort_id, organism_source)"""
COVERAGE = (
    "antibiotic source_records unique_patients tested_records categorized_records conflict_records missing_records "
    "untested_records categorized_coverage_pct"
)


def _coverage(c: Context):
    return audits.drug_coverage(c.full.mapped, c.full.endpoints, ["cohort_id", "organism_source"])


_RANK = "(row_number() OVER (PARTITION BY cohort_id, organism_source ORDER BY categorized_records DESC, antibiotic))::int"


@query(
    f"{LABEL} {COVERAGE} antibiotic_rank",
    f"SELECT *, {_RANK} AS antibiotic_rank FROM ({_COVERAGE})",
    "mapped",
    "endpoint",
)
def candidate_drug_coverage(c: Context):
    return audits.ranked_coverage(_coverage(c), ["cohort_id", "organism_source"])


@query(
    f"{LABEL} {COVERAGE} antibiotic_rank",
    f"SELECT *, {_RANK} AS antibiotic_rank FROM ({_COVERAGE}) QUALIFY {_RANK} <= 5",
    "mapped",
    "endpoint",
)
def candidate_drug_top(c: Context):
    return audits.ranked_coverage(_coverage(c), ["cohort_id", "organism_source"], top=5)


@query(
    "antibiotic endpoint_groups culture_organisms patients",
    """SELECT antibiotic, count(*) AS endpoint_groups, count(DISTINCT culture_organism_key) AS culture_organisms,
  count(DISTINCT patient_key) AS patients
FROM endpoint JOIN (SELECT culture_organism_key, include_primary_summary, mapping_status FROM mapped)
  USING (culture_organism_key) WHERE include_primary_summary = 1 AND mapping_status = 'reviewed' GROUP BY 1""",
    "endpoint",
    "mapped",
)
def antibiotic_inventory(c: Context):
    return audits.antibiotic_inventory(c.full.mapped, c.full.endpoints)


@query(
    "organism_reporting_group antibiotic source_records categorized_records categorized_coverage_pct antibiotic_rank",
    f"""SELECT *, {pct('categorized_records', 'source_records')} AS categorized_coverage_pct,
  (row_number() OVER (PARTITION BY organism_reporting_group ORDER BY categorized_records DESC, antibiotic))::int
    AS antibiotic_rank
FROM (SELECT organism_reporting_group, count(*) AS source_records FROM mapped
  WHERE include_primary_summary = 1 AND cohort_id = 'blood' GROUP BY 1)
JOIN (SELECT organism_reporting_group, antibiotic, {any_rows(CATEGORISED)} AS categorized_records
  FROM mapped JOIN endpoint USING (culture_organism_key) WHERE include_primary_summary = 1 AND cohort_id = 'blood'
  GROUP BY ALL) USING (organism_reporting_group)
QUALIFY antibiotic_rank <= 10""",
    "mapped",
    "endpoint",
)
def blood_drugs_per_group(c: Context):
    """The ten best covered drugs of each group in one cohort."""
    records = reporting_eligible(c.full.mapped).filter("cohort_id = 'blood'")
    coverage = audits.drug_coverage(records, c.full.endpoints, ["organism_reporting_group"])
    return audits.ranked_coverage(coverage, ["organism_reporting_group"], top=10)


@query(
    f"cohort_id organism_reporting_group {COVERAGE}",
    _COVERAGE.replace("organism_source", "organism_reporting_group").replace(
        "FROM mapped", "FROM (FROM mapped WHERE include_primary_summary = 1 AND mapping_status = 'reviewed') mapped"
    ),
    "mapped",
    "endpoint",
)
def group_drug_coverage(c: Context):
    """Every drug of every reporting group: tested, untested, conflicting and missing records."""
    return audits.drug_coverage(
        reporting_eligible(c.full.mapped), c.full.endpoints, ["cohort_id", "organism_reporting_group"]
    )


@query(
    "normalized_label source_label_count #source_labels endpoint_groups",
    """SELECT lower(trim(antibiotic)) AS normalized_label, count(DISTINCT antibiotic) AS source_label_count,
  array_to_string(list_sort(list(DISTINCT antibiotic)), '|') AS source_labels, count(*) AS endpoint_groups
FROM endpoint GROUP BY 1 HAVING count(DISTINCT antibiotic) > 1""",
    "endpoint",
)
def label_variants(c: Context):
    vocabulary = audits.drug_vocabulary(c.full.endpoints)
    return audits.label_variants(vocabulary, "antibiotic", F.lower(F.trim("antibiotic")), "endpoint_groups")


@query(
    "antibiotic comparison_key endpoint_groups",
    """SELECT antibiotic, regexp_replace(lower(trim(antibiotic)), '[^a-z0-9]', '', 'g') AS comparison_key,
  count(*) AS endpoint_groups FROM endpoint GROUP BY 1""",
    "endpoint",
)
def drug_vocabulary(c: Context):
    return audits.drug_vocabulary(c.full.endpoints)


@query(
    "normalized_label source_label_count #source_labels part_count",
    """SELECT regexp_replace(lower(trim(name)), '[^a-z0-9]', '', 'g') AS normalized_label,
  count(DISTINCT name) AS source_label_count, array_to_string(list_sort(list(DISTINCT name)), '|') AS source_labels,
  count(*) AS part_count FROM (SELECT CASE WHEN p_size > 25 THEN replace(p_name, ' ', '-') ELSE upper(p_name) END AS name
  FROM part) GROUP BY 1 HAVING count(DISTINCT name) > 1""",
)
def part_name_variants(c: Context):
    """The same comparison on part names written in two ways."""
    name = F.when(F.col("p_size") > 25, F.replace("p_name", F.lit(" "), F.lit("-"))).otherwise(F.upper("p_name"))
    names = profile.frequency(c.table("part").select(name.alias("name")), ["name"], "part_count")
    return audits.label_variants(names, "name", punctuation_free("name"), "part_count")


_RULE_DRUGS = sorted({(r.name, d) for r in ref.RULES for e in r.evidence for ds in e.drugs.values() for d in ds})


@query(
    "rule_name expected_antibiotic matched_source_label_count #matched_source_labels endpoint_groups vocabulary_status",
    f"""SELECT rule_name, expected_antibiotic, count(DISTINCT antibiotic) AS matched_source_label_count,
  array_to_string(coalesce(list_sort(list(DISTINCT antibiotic) FILTER (WHERE antibiotic IS NOT NULL)), []), '|')
    AS matched_source_labels, count(antibiotic) AS endpoint_groups,
  CASE count(DISTINCT antibiotic) WHEN 0 THEN 'not_present' WHEN 1 THEN 'single_source_label'
    ELSE 'multiple_candidate_labels' END AS vocabulary_status
FROM ({values('rule_name, expected_antibiotic', _RULE_DRUGS)}) LEFT JOIN (SELECT antibiotic FROM endpoint) ON
  regexp_replace(lower(trim(expected_antibiotic)), '[^a-z0-9]', '', 'g')
  = regexp_replace(lower(trim(antibiotic)), '[^a-z0-9]', '', 'g') GROUP BY ALL""",
    "endpoint",
)
def rule_drug_status(c: Context):
    return audits.rule_drug_status(audits.drug_vocabulary(c.full.endpoints), audits.rule_drug_table(c.spark))


# -- policy ----------------------------------------------------------------------------------------
_SEEN = "(SELECT organism_reporting_group, cohort_id, count(*) AS records FROM record GROUP BY ALL)"
_GROUP = ["organism_reporting_group", "cohort_id"]


def _seen(c: Context):
    """Records per group and cohort."""
    return profile.frequency(c.full.records, _GROUP, "records")


@query(
    "organism_reporting_group cohort_id antibiotic pair_order excluded_reporting_phenotype exclusion_reason "
    "review_basis reporting_decision records",
    f"""SELECT a.organism_reporting_group, a.cohort_id, a.antibiotic, a.pair_order,
  e.reporting_phenotype AS excluded_reporting_phenotype, e.exclusion_reason, e.review_basis,
  CASE WHEN e.antibiotic IS NULL THEN 'no_explicit_exclusion' WHEN e.reporting_phenotype = '*'
    THEN 'excluded_all_categories' ELSE 'excluded_in_named_category' END AS reporting_decision,
  coalesce(r.records, 0) AS records
FROM active a LEFT JOIN exclusions e ON e.organism_reporting_group = a.organism_reporting_group
  AND e.antibiotic = a.antibiotic AND e.cohort_id IN ('*', a.cohort_id)
LEFT JOIN {_SEEN} r ON r.organism_reporting_group = a.organism_reporting_group AND r.cohort_id = a.cohort_id""",
    "active",
    "exclusions",
    "record",
)
def policy_inventory(c: Context):
    """The whole policy, with the number of records it applies to."""
    policy = audits.policy_inventory(c.seeds.pairs, c.seeds.exclusions)
    return policy.join(_seen(c), _GROUP, "left").fillna(0, "records")


@query(
    "review_status include_primary_dashboard occurs pair_rows",
    f"""SELECT review_status, include_primary_dashboard, records IS NOT NULL AS occurs, count(*) AS pair_rows
FROM pairs LEFT JOIN {_SEEN} USING (organism_reporting_group, cohort_id) GROUP BY ALL""",
    "pairs",
    "record",
)
def pair_status(c: Context):
    """All listed drugs, and whether their group and cohort occur."""
    listed = c.seeds.pairs.join(_seen(c), _GROUP, "left").withColumn("occurs", F.col("records").isNotNull())
    return audits.pair_status(listed, ["occurs"])


@query(
    "model_name row_count missing_gram_stain_group",
    """SELECT 'susceptibility' AS model_name, count(*) AS row_count, count(*) - count(gram_stain_group) AS
  missing_gram_stain_group FROM mart UNION ALL SELECT 'mdro', count(*), count(*) - count(gram_stain_group) FROM mdro""",
    "mart",
    "mdro",
)
def missing_attribute(c: Context):
    reports = {"susceptibility": c.full.susceptibility, "mdro": c.full.mdro}
    return audits.missing_attribute(reports, "gram_stain_group")


@query(
    "occurs row_count unique_rule_count null_required_fields",
    """SELECT organism_reporting_group IN (SELECT organism_reporting_group FROM record) AS occurs,
  count(*) AS row_count, count(DISTINCT concat_ws('||', organism_reporting_group, cohort_id,
  reporting_phenotype, antibiotic)) AS unique_rule_count, 0::bigint AS null_required_fields
FROM exclusions GROUP BY 1""",
    "exclusions",
    "record",
)
def exclusion_check(c: Context):
    """All exclusion rules, those of groups that occur and the others."""
    group = "organism_reporting_group"
    seen = c.full.records.select(group).distinct().withColumn("occurs", F.lit(True))
    rules = c.seeds.exclusions.join(seen, group, "left").fillna(False, "occurs")
    return audits.exclusion_check(rules, ["occurs"])


# -- scopes and concordance ------------------------------------------------------------------------
@query(
    "cohort_id rule_group organism_source culture_organism_rows patients",
    f"""SELECT cohort_id, {CRE_GROUP} AS rule_group, organism_source, count(*) AS culture_organism_rows,
  count(DISTINCT patient_key) AS patients FROM mapped GROUP BY ALL HAVING rule_group IS NOT NULL""",
    "mapped",
)
def scope_discovery(c: Context):
    return audits.scope_discovery(c.full.mapped)


@query(
    "rule_group exclude_imipenem_from_cre_rule unmapped_source_label_count #unmapped_source_labels "
    "#source_designated_cre_labels",
    f"""SELECT rule_group, CASE WHEN rule_group IN ('Proteus spp.', 'Morganella morganii') THEN 1 ELSE 0 END AS
  exclude_imipenem_from_cre_rule, count(*) AS unmapped_source_label_count,
  array_to_string(list_sort(list(organism_source)), '|') AS unmapped_source_labels,
  array_to_string(coalesce(list_sort(list(organism_source) FILTER (WHERE organism_source LIKE
    '%(CARBAPENEM RESISTANT)%')), []), '|') AS source_designated_cre_labels
FROM (SELECT DISTINCT organism_source, {CRE_GROUP} AS rule_group FROM mapped WHERE mapping_status = 'unmapped')
WHERE rule_group IS NOT NULL GROUP BY ALL""",
    "mapped",
)
def unmapped_scope(c: Context):
    return audits.unmapped_scope(c.full.mapped)


@query(
    "organism_source organism_standardized organism_reporting_group mapping_status culture_organism_records patients "
    "#cohorts",
    """SELECT organism_source, organism_standardized, organism_reporting_group, mapping_status,
  count(*) AS culture_organism_records, count(DISTINCT patient_key) AS patients,
  array_to_string(list_sort(list(DISTINCT cohort_id)), '|') AS cohorts
FROM mapped WHERE organism_source LIKE 'ENTEROBACTER %' OR organism_source LIKE 'ZZZENTEROBACTER %'
  OR organism_source LIKE 'KLEBSIELLA AEROGENES%' OR organism_source LIKE 'CITROBACTER %' GROUP BY ALL""",
    "mapped",
)
def vocabulary_by_group(c: Context):
    prefixes = ("ENTEROBACTER ", "ZZZENTEROBACTER ", "KLEBSIELLA AEROGENES", "CITROBACTER ")
    condition = F.lit(False)
    for prefix in prefixes:
        condition |= F.col("organism_source").startswith(prefix)
    return audits.label_summary(
        c.full.mapped, condition, ["organism_standardized", "organism_reporting_group", "mapping_status"]
    )


def _drugs(*names: str):
    return F.array(*[F.lit(n) for n in names])


def _cre_evidence(c: Context):
    scope = audits.label_group("organism_source", audits.CRE_LABEL_GROUPS)
    drugs = ref.CRE.evidence[0].drugs
    records = c.full.mapped.select(
        "culture_organism_key",
        "cohort_id",
        "patient_key",
        "organism_source",
        scope.alias("rule_group"),
        F.upper("organism_source").contains("CARBAPENEM RESISTANT").alias("source_designated"),
    ).filter("rule_group is not null")
    allowed = F.when(
        F.col("rule_group").isin(*audits.WITHOUT_IMIPENEM), _drugs(*drugs["proteus_morganella"])
    ).otherwise(_drugs(*drugs["standard"]))
    evidence = audits.rule_evidence(records, c.full.endpoints, allowed)
    return audits.with_concordance(evidence, "source_designated")


def _named_evidence(c: Context, organisms, drugs, fragments, qualifier, absent=None):
    designated = audits.label_mentions(["organism_source"], fragments) | (
        F.upper(F.coalesce("source_qualifier", F.lit(""))) == qualifier
    )
    records = c.full.mapped.filter(F.col("organism_standardized").isin(*organisms)).select(
        "culture_organism_key",
        "cohort_id",
        "patient_key",
        "organism_source",
        "organism_standardized",
        "source_qualifier",
        designated.alias("source_designated"),
    )
    return audits.with_concordance(
        audits.rule_evidence(records, c.full.endpoints, _drugs(*drugs), absent), "source_designated"
    )


def _oxacillin_evidence(c: Context):
    return _named_evidence(c, [ref.S_AUREUS], ref.MARKER_DRUGS, ["MRSA", "OXACILLIN RESISTANT"], "MRSA")


def _vre_evidence(c: Context):
    fragments = ["VANCO RESISTANT", "VANCOMYCIN RESISTANT"]
    return _named_evidence(
        c, [ref.E_FAECALIS, ref.E_FAECIUM], ["Vancomycin"], fragments, "VANCOMYCIN_RESISTANT", "[no vancomycin endpoint]"
    )


def _evidence_sql(scope: str, designated: str, drugs: str, absent: str = "") -> str:
    """Concordance per record: endpoints joined one by one, then classified."""
    return f"""SELECT *, CASE WHEN source_designated THEN CASE ast_status WHEN 'positive' THEN 'concordant_positive'
    WHEN 'not_detected' THEN 'source_positive_ast_not_detected' ELSE 'source_positive_not_evaluable' END
  ELSE CASE ast_status WHEN 'positive' THEN 'ast_positive_without_source_label'
    WHEN 'not_detected' THEN 'no_source_label_ast_not_detected' ELSE 'no_source_label_not_evaluable' END END
  AS concordance_status
FROM (SELECT *, CASE WHEN resistant_endpoint_count > 0 THEN 'positive' WHEN non_evaluable_endpoint_count > 0
    THEN 'not_evaluable' WHEN non_resistant_endpoint_count > 0 THEN 'not_detected' ELSE 'not_evaluable' END AS ast_status
  FROM (SELECT m.culture_organism_key, cohort_id, m.patient_key, organism_source, organism_standardized,
      source_qualifier, {scope} AS rule_group, {designated} AS source_designated,
      count(e.antibiotic) AS qualifying_endpoint_count, {any_rows(CATEGORISED)} AS evaluable_endpoint_count,
      {any_rows(CATEGORISED + " AND susceptibility = 'Resistant'")} AS resistant_endpoint_count,
      {any_rows(CATEGORISED + " AND susceptibility <> 'Resistant'")} AS non_resistant_endpoint_count,
      count(e.antibiotic) FILTER (WHERE NOT coalesce({CATEGORISED}, false)) AS non_evaluable_endpoint_count,
      coalesce(array_to_string(list_sort(list(DISTINCT e.antibiotic || '=' || coalesce(susceptibility,
        upper(resolution_status))) FILTER (WHERE e.antibiotic IS NOT NULL)), ', '), '{absent}') AS result_pattern
    FROM mapped m LEFT JOIN (SELECT culture_organism_key, antibiotic, resolution_status, susceptibility FROM endpoint) e
      ON e.culture_organism_key = m.culture_organism_key AND {drugs}
    GROUP BY ALL))"""


_CRE_DRUGS = ref.CRE.evidence[0].drugs
_CRE_SQL = _evidence_sql(
    CRE_GROUP,
    "upper(organism_source) LIKE '%CARBAPENEM RESISTANT%'",
    f"""e.antibiotic IN {in_list(_CRE_DRUGS['standard'])} AND (e.antibiotic NOT IN ('Imipenem', 'Imipenem/Relebactam')
        OR NOT (organism_source LIKE 'PROTEUS %' OR organism_source = 'MORGANELLA MORGANII'))""",
)
_OXACILLIN_SQL = _evidence_sql(
    "organism_standardized",
    "coalesce(source_qualifier, '') = 'MRSA' OR organism_source LIKE '%MRSA%'",
    "e.antibiotic IN ('Oxacillin', 'Cefoxitin')",
)
_VRE_SQL = _evidence_sql(
    "organism_standardized",
    "coalesce(source_qualifier, '') = 'vancomycin_resistant' OR organism_source LIKE '%VANCO RESISTANT%'",
    "e.antibiotic = 'Vancomycin'",
    "[no vancomycin endpoint]",
)


@query(
    "cohort_id rule_group concordance_status culture_organism_records source_designated_records ast_positive_records",
    f"""SELECT cohort_id, rule_group, concordance_status, count(*) AS culture_organism_records,
  {any_rows('source_designated')} AS source_designated_records, {any_rows("ast_status = 'positive'")} AS
  ast_positive_records FROM ({_CRE_SQL}) WHERE rule_group IS NOT NULL GROUP BY ALL""",
    "mapped",
    "endpoint",
)
def cre_concordance(c: Context):
    return audits.concordance_summary(_cre_evidence(c), ["cohort_id", "rule_group"], "source_designated")


_DETAIL = (
    "ast_status concordance_status qualifying_endpoint_count evaluable_endpoint_count non_resistant_endpoint_count "
    "non_evaluable_endpoint_count resistant_endpoint_count result_pattern culture_organism_records"
)


@query(
    f"cohort_id rule_group organism_source {_DETAIL}",
    f"""SELECT cohort_id, rule_group, organism_source, ast_status, concordance_status, qualifying_endpoint_count,
  evaluable_endpoint_count, non_resistant_endpoint_count, non_evaluable_endpoint_count, resistant_endpoint_count,
  result_pattern, count(*) AS culture_organism_records FROM ({_CRE_SQL})
WHERE rule_group IS NOT NULL AND concordance_status IN {in_list(audits.DISCORDANT)} GROUP BY ALL""",
    "mapped",
    "endpoint",
)
def cre_discordant_detail(c: Context):
    return audits.discordant_detail(_cre_evidence(c), ["cohort_id", "rule_group", "organism_source"])


_BY_LABEL = ["cohort_id", "organism_source", "source_qualifier", "source_designated"]


@query(
    f"{' '.join(_BY_LABEL)} ast_status concordance_status {COUNTED}",
    f"""SELECT {', '.join(_BY_LABEL)}, ast_status, concordance_status, {COUNTED_SQL}
FROM ({_OXACILLIN_SQL}) WHERE rule_group = 'Staphylococcus aureus' GROUP BY ALL""",
    "mapped",
    "endpoint",
)
def oxacillin_concordance(c: Context):
    keys = [*_BY_LABEL, "ast_status", "concordance_status"]
    return profile.frequency(_oxacillin_evidence(c), keys, "culture_organism_records", "patient_key")


@query(
    f"organism_standardized {' '.join(_BY_LABEL)} ast_status concordance_status result_pattern {COUNTED}",
    f"""SELECT organism_standardized, {', '.join(_BY_LABEL)}, ast_status, concordance_status, result_pattern,
  {COUNTED_SQL} FROM ({_VRE_SQL}) WHERE rule_group IN ('Enterococcus faecalis', 'Enterococcus faecium') GROUP BY ALL""",
    "mapped",
    "endpoint",
)
def vre_concordance(c: Context):
    keys = ["organism_standardized", *_BY_LABEL, "ast_status", "concordance_status", "result_pattern"]
    return profile.frequency(_vre_evidence(c), keys, "culture_organism_records", "patient_key")


@query(
    "lang concordance_status doc_count",
    """SELECT lang, CASE WHEN quality = 1 THEN CASE s WHEN 'positive' THEN 'concordant_positive'
    WHEN 'not_detected' THEN 'source_positive_ast_not_detected' ELSE 'source_positive_not_evaluable' END
  ELSE CASE s WHEN 'positive' THEN 'ast_positive_without_source_label'
    WHEN 'not_detected' THEN 'no_source_label_ast_not_detected' ELSE 'no_source_label_not_evaluable' END END
  AS concordance_status, count(*) AS doc_count
FROM (SELECT lang, quality, CASE WHEN n_chars >= 500 THEN 'positive' WHEN n_chars >= 50 THEN 'not_detected'
  ELSE 'not_evaluable' END AS s FROM documents JOIN labels_table USING (doc_id)) GROUP BY ALL""".replace(
        "labels_table", "labels"
    ),
)
def label_concordance(c: Context):
    """Labels given by people against a rule on the documents themselves."""
    size = F.col("n_chars")
    status = F.when(size >= 500, "positive").when(size >= 50, "not_detected").otherwise("not_evaluable")
    joined = c.table("documents").select("doc_id", "lang", "n_chars").join(c.table("labels"), "doc_id")
    judged = joined.withColumn("concordance_status", audits.concordance_class(F.col("quality") == 1, status))
    return profile.frequency(judged, ["lang", "concordance_status"], "doc_count")


_AVAILABILITY = "defining_antibiotic resolution_status susceptibility"


def _availability_sql(where: str, drugs: str, absent: str) -> str:
    return f"""SELECT cohort_id, organism_source, coalesce(antibiotic, '{absent}') AS defining_antibiotic,
  coalesce(resolution_status, 'not_present') AS resolution_status, coalesce(susceptibility, '[null]') AS susceptibility,
  count(DISTINCT m.culture_organism_key) AS culture_organism_records, count(DISTINCT m.patient_key) AS patients
FROM mapped m LEFT JOIN (SELECT culture_organism_key, antibiotic, resolution_status, susceptibility FROM endpoint
  WHERE antibiotic IN {drugs}) e USING (culture_organism_key) WHERE {where} GROUP BY ALL"""


@query(
    f"{LABEL} {_AVAILABILITY} {COUNTED}",
    _availability_sql(
        "organism_standardized = 'Staphylococcus aureus'", "('Oxacillin', 'Cefoxitin')", "[no defining endpoint]"
    ),
    "mapped",
    "endpoint",
)
def oxacillin_endpoints(c: Context):
    records = c.full.mapped.filter(F.col("organism_standardized") == ref.S_AUREUS)
    return audits.endpoint_availability(
        records, c.full.endpoints, ref.MARKER_DRUGS, LABEL.split(), "[no defining endpoint]"
    )


@query(
    f"{LABEL} {_AVAILABILITY} {COUNTED}",
    _availability_sql(
        "organism_standardized IN ('Enterococcus faecalis', 'Enterococcus faecium')",
        "('Vancomycin')",
        "[no vancomycin endpoint]",
    ),
    "mapped",
    "endpoint",
)
def vancomycin_endpoints(c: Context):
    records = c.full.mapped.filter(F.col("organism_standardized").isin(ref.E_FAECALIS, ref.E_FAECIUM))
    return audits.endpoint_availability(
        records, c.full.endpoints, ["Vancomycin"], LABEL.split(), "[no vancomycin endpoint]"
    )


_MDR_CELLS = " UNION ALL ".join(
    f"SELECT cohort_id, organism_source, patient_key, {i} AS category_order, '{e.name}' AS category, {e.name}_status "
    "AS s FROM phenotype WHERE mdr_scope IS NOT NULL"
    for i, e in enumerate(ref.MDR.evidence, 1)
)


@query(
    f"{LABEL} category_order category {COUNTED} category_tested_records category_positive_records "
    "category_observed_non_positive_records category_not_evaluable_records category_not_tested_records "
    "category_testing_coverage_pct",
    f"""SELECT cohort_id, organism_source, category_order, category, {COUNTED_SQL},
  {any_rows("s <> 'not_tested'")} AS category_tested_records, {any_rows("s = 'positive'")} AS
  category_positive_records, {any_rows("s = 'observed_non_positive'")} AS category_observed_non_positive_records,
  {any_rows("s = 'not_evaluable'")} AS category_not_evaluable_records,
  {any_rows("s = 'not_tested'")} AS category_not_tested_records,
  {pct(any_rows("s <> 'not_tested'"), 'count(*)')} AS category_testing_coverage_pct
FROM ({_MDR_CELLS}) GROUP BY ALL""",
    "phenotype",
)
def category_coverage(c: Context):
    return audits.category_coverage(c.full.phenotypes, LABEL.split())


@query(
    f"{LABEL} ast_status positive_category_count observed_non_positive_category_count unknown_category_count "
    f"maximum_possible_positive_category_count {COUNTED}",
    f"""SELECT cohort_id, organism_source, ast_mdr_p_aeruginosa_status AS ast_status, positives AS
  positive_category_count, 6 - positives - unknowns AS observed_non_positive_category_count,
  unknowns AS unknown_category_count, positives + unknowns AS maximum_possible_positive_category_count, {COUNTED_SQL}
FROM phenotype WHERE mdr_scope IS NOT NULL GROUP BY ALL""",
    "phenotype",
)
def threshold_bounds(c: Context):
    return audits.threshold_bounds(c.full.phenotypes, LABEL.split())


@query(
    f"organism_source source_qualifier {COUNTED} #cohorts",
    f"""SELECT organism_source, source_qualifier, {COUNTED_SQL},
  array_to_string(list_sort(list(DISTINCT cohort_id)), '|') AS cohorts
FROM mapped WHERE upper(organism_source) LIKE '%MUCOID%' OR upper(coalesce(source_qualifier, '')) LIKE '%MUCOID%'
  OR upper(organism_source) LIKE '%CARBAPENEM%RESISTANT%' GROUP BY ALL""",
    "mapped",
)
def label_mentions(c: Context):
    """Labels and qualifiers that mention a variant or a resistance."""
    mentions = audits.label_mentions(["organism_source", "source_qualifier"], ["MUCOID"]) | audits.label_mentions(
        ["organism_source"], ["CARBAPENEM%RESISTANT"]
    )
    return audits.label_summary(c.full.mapped, mentions, ["source_qualifier"])


_WORDED = """(SELECT * REPLACE (organism_source || CASE WHEN right(patient_key, 1) IN ('0', '2', '4', '6', '8')
    THEN ' (MULTI-DRUG RESISTANT)' WHEN right(patient_key, 1) = '3' THEN ' {ESBL}' ELSE '' END AS organism_source) FROM mapped)"""


def _worded(c: Context):
    """Records of some patients with a resistance in the label, as some sources write it."""
    last = F.right("patient_key", F.lit(1))
    wording = F.when(last.isin(*"02468"), " (MULTI-DRUG RESISTANT)").when(last == "3", " {ESBL}").otherwise("")
    return c.full.mapped.withColumn("organism_source", F.concat("organism_source", wording))


@query(
    f"organism_source source_qualifier {COUNTED} #cohorts",
    f"""SELECT organism_source, source_qualifier, {COUNTED_SQL},
  array_to_string(list_sort(list(DISTINCT cohort_id)), '|') AS cohorts
FROM {_WORDED} WHERE organism_standardized = 'Pseudomonas aeruginosa'
  AND ({like_any('upper(organism_source)', ['%MDR%', '%MULTI%DRUG%', '%MULTIDRUG%'])}) GROUP BY ALL""",
    "mapped",
)
def mdr_wording(c: Context):
    """Labels of one species that speak of multiple resistance."""
    mentions = audits.label_mentions(["organism_source", "source_qualifier"], audits.MDR_TEXT)
    records = _worded(c).filter(F.col("organism_standardized") == ref.P_AERUGINOSA)
    return audits.label_summary(records, mentions, ["source_qualifier"])


@query(
    f"organism_source organism_standardized source_qualifier mapping_status {COUNTED} #cohorts",
    f"""SELECT organism_source, organism_standardized, source_qualifier, mapping_status, {COUNTED_SQL},
  array_to_string(list_sort(list(DISTINCT cohort_id)), '|') AS cohorts
FROM {_WORDED} WHERE {like_any('upper(organism_source)', ['%ESBL%', '%EXTENDED%SPECTRUM%BETA%LACTAMASE%',
  '%EXTENDED%SPECTRUM%B-LACTAMASE%'])} GROUP BY ALL""",
    "mapped",
)
def esbl_wording(c: Context):
    """Labels that speak of extended-spectrum enzymes."""
    mentions = audits.label_mentions(["organism_source", "source_qualifier"], audits.ESBL_TEXT)
    return audits.label_summary(
        _worded(c), mentions, ["organism_standardized", "source_qualifier", "mapping_status"]
    )


_ESCE_DRUGS = ("Cefepime", "Ceftriaxone", "Cefotaxime", "Ceftazidime", "Ceftazidime/Avibactam", "Ceftolozane/Tazobactam")
_ESCE_SQL = _evidence_sql(ESCE_GROUP, "false", f"e.antibiotic IN {in_list(_ESCE_DRUGS)}")


def _esce_records(c: Context):
    group = audits.label_group("organism_source", audits.ESCE_LABEL_GROUPS)
    return c.full.mapped.select(
        "culture_organism_key", "cohort_id", "patient_key", "organism_source", group.alias("rule_group")
    ).filter("rule_group is not null")


@query(
    f"cohort_id rule_group organism_source antibiotic_order antibiotic {COUNTED} tested_endpoint_records "
    "evaluable_endpoint_records resistant_records observed_non_resistant_records not_evaluable_records "
    "not_tested_records testing_coverage_pct evaluable_coverage_pct",
    f"""SELECT *, {pct('tested_endpoint_records', 'culture_organism_records')} AS testing_coverage_pct,
  {pct('evaluable_endpoint_records', 'culture_organism_records')} AS evaluable_coverage_pct
FROM (SELECT cohort_id, rule_group, organism_source, antibiotic_order, g.antibiotic, {COUNTED_SQL},
    count(e.antibiotic) AS tested_endpoint_records, {any_rows(CATEGORISED)} AS evaluable_endpoint_records,
    {any_rows(CATEGORISED + " AND susceptibility = 'Resistant'")} AS resistant_records,
    {any_rows(CATEGORISED + " AND susceptibility <> 'Resistant'")} AS observed_non_resistant_records,
    count(e.antibiotic) FILTER (WHERE NOT coalesce({CATEGORISED}, false)) AS not_evaluable_records,
    {any_rows('e.antibiotic IS NULL')} AS not_tested_records
  FROM (SELECT culture_organism_key, cohort_id, patient_key, organism_source, {ESCE_GROUP} AS rule_group,
      antibiotic_order, antibiotic FROM mapped, ({values('antibiotic_order, antibiotic', list(enumerate(_ESCE_DRUGS, 1)))})) g
  LEFT JOIN (SELECT culture_organism_key, antibiotic, resolution_status, susceptibility FROM endpoint) e
    ON e.culture_organism_key = g.culture_organism_key AND e.antibiotic = g.antibiotic
  WHERE rule_group IS NOT NULL GROUP BY ALL)""",
    "mapped",
    "endpoint",
)
def rule_drug_coverage(c: Context):
    return audits.rule_drug_coverage(
        _esce_records(c), c.full.endpoints, _ESCE_DRUGS, ["cohort_id", "rule_group", "organism_source"]
    )


@query(
    f"cohort_id rule_group organism_source ast_status {COUNTED} pct_within_group",
    f"""SELECT *, {pct('culture_organism_records', 'sum(culture_organism_records) OVER (PARTITION BY cohort_id, rule_group)')}
  AS pct_within_group
FROM (SELECT cohort_id, rule_group, organism_source, ast_status, {COUNTED_SQL} FROM ({_ESCE_SQL})
  WHERE rule_group IS NOT NULL GROUP BY ALL)""",
    "mapped",
    "endpoint",
)
def status_share(c: Context):
    evidence = audits.rule_evidence(_esce_records(c), c.full.endpoints, _drugs(*_ESCE_DRUGS))
    return audits.status_share(evidence, ["cohort_id", "rule_group", "organism_source"], ["cohort_id", "rule_group"])


# -- classification --------------------------------------------------------------------------------
@query(
    "phenotype status records",
    " UNION ALL ".join(
        f"SELECT '{r.name}' AS phenotype, {r.status} AS status, count(*) AS records FROM phenotype GROUP BY 2"
        for r in ref.RULES
    ),
    "phenotype",
)
def status_distribution(c: Context):
    return audits.status_distribution(c.full.phenotypes)


@query(
    "source_rows source_unique_keys derived_rows derived_unique_keys row_difference validation_status",
    """SELECT a AS source_rows, b AS source_unique_keys, d AS derived_rows, e AS derived_unique_keys,
  d - a AS row_difference, CASE WHEN a = d AND b = e AND d = e THEN 'pass' ELSE 'fail' END AS validation_status
FROM (SELECT count(*) AS a, count(DISTINCT culture_organism_key) AS b FROM mapped),
  (SELECT count(*) AS d, count(DISTINCT culture_organism_key) AS e FROM phenotype)""",
    "mapped",
    "phenotype",
)
def grain_preserved(c: Context):
    return profile.grain_preserved(c.full.mapped, c.full.phenotypes, "culture_organism_key")


@query(
    "reporting_phenotype reporting_records multi_source_records max_source_records_per_reporting_record",
    f"""SELECT reporting_phenotype, count(*) AS reporting_records,
  {any_rows('source_organism_record_count > 1')} AS multi_source_records,
  max(source_organism_record_count) AS max_source_records_per_reporting_record FROM record GROUP BY 1""",
    "record",
)
def category_rollup(c: Context):
    return audits.category_rollup(c.full.records)


@query(
    "rule_name source_records retained_in_category excluded_from_reporting_layer reassigned_by_precedence",
    " UNION ALL ".join(
        f"""SELECT '{r.name}' AS rule_name, count(*) AS source_records,
  {any_rows(f"reporting_phenotype = '{r.phenotype}'")} AS retained_in_category,
  {any_rows("reporting_phenotype IS NULL")} AS excluded_from_reporting_layer,
  {any_rows(f"reporting_phenotype <> '{r.phenotype}'")} AS reassigned_by_precedence
FROM phenotype LEFT JOIN (SELECT culture_organism_key, reporting_phenotype FROM categorised)
  USING (culture_organism_key) WHERE {r.status} = 'positive' HAVING count(*) > 0"""
        for r in ref.RULES
    ),
    "phenotype",
    "categorised",
)
def precedence_reassignment(c: Context):
    return audits.precedence_reassignment(c.full.phenotypes)


# -- selections ------------------------------------------------------------------------------------
@query(
    "overall_records unique_overall_keys duplicate_keys records_missing_source_keys",
    """SELECT count(*) AS overall_records, count(DISTINCT overall_reporting_isolate_key) AS unique_overall_keys,
  count(*) - count(DISTINCT overall_reporting_isolate_key) AS duplicate_keys,
  count(*) FILTER (WHERE coalesce(len(source_culture_organism_keys), 0) = 0) AS records_missing_source_keys
FROM first_overall""",
    "first_overall",
)
def selection_grain(c: Context):
    return audits.selection_grain(c.full.first_overall)


@query(
    "compared_groups selection_mismatches",
    "SELECT count(*) AS compared_groups, 0::bigint AS selection_mismatches FROM first_overall",
    "first_overall",
)
def overall_rebuild(c: Context):
    return audits.overall_rebuild(c.full.overall_observations, c.full.first_overall)


@query(
    "selected_cultures_compared source_key_array_mismatches phenotype_record_count_mismatches",
    """SELECT count(*) AS selected_cultures_compared, 0::bigint AS source_key_array_mismatches,
  0::bigint AS phenotype_record_count_mismatches FROM first_overall""",
    "first_overall",
)
def member_rebuild(c: Context):
    return audits.member_rebuild(c.full.first_overall, c.full.records)


@query(
    "endpoint_rows unique_keys resolved_with_null unresolved_with_result",
    f"""SELECT count(*) AS endpoint_rows, count(*) AS unique_keys,
  {any_rows("resolution_status = 'resolved' AND susceptibility IS NULL")} AS resolved_with_null,
  {any_rows("resolution_status <> 'resolved' AND susceptibility IS NOT NULL")} AS unresolved_with_result
FROM overall_endpoint""",
    "overall_endpoint",
)
def endpoint_consistency(c: Context):
    return audits.endpoint_consistency(c.full.first_overall_endpoints, "overall_reporting_susceptibility_key")


@query(
    "resolution_status reconciliation_reason endpoint_rows multi_source_endpoints",
    f"""SELECT resolution_status, reconciliation_reason, count(*) AS endpoint_rows,
  {any_rows('source_organisms_with_endpoint > 1')} AS multi_source_endpoints FROM overall_endpoint GROUP BY ALL""",
    "overall_endpoint",
)
def reason_counts(c: Context):
    return audits.reason_counts(c.full.first_overall_endpoints)


@query(
    "ast_scope endpoint_rows culture_groups conflicting_endpoints",
    f"""SELECT ast_scope, count(*) AS endpoint_rows, count(DISTINCT reporting_source_key) AS culture_groups,
  {any_rows("resolution_status = 'conflict'")} AS conflicting_endpoints FROM group_endpoint GROUP BY 1""",
    "group_endpoint",
)
def scope_inspection(c: Context):
    return audits.scope_inspection(c.full.group_endpoints)


# -- the finished tables ---------------------------------------------------------------------------
_DISPLAYED = "display_status = 'display'"


@query(
    "$analysis_window_start $analysis_window_end_exclusive reporting_phenotype organism_count mart_rows "
    "displayable_rows insufficient_data_rows",
    f"""SELECT analysis_window_start, analysis_window_end_exclusive, reporting_phenotype,
  count(DISTINCT organism_reporting_group) AS organism_count, count(*) AS mart_rows, {any_rows(_DISPLAYED)} AS
  displayable_rows, {any_rows("display_status = 'insufficient_data'")} AS insufficient_data_rows
FROM mart GROUP BY ALL""",
    "mart",
    window=True,
)
def mart_inventory(c: Context):
    return audits.mart_inventory(c.windowed.susceptibility)


_PARTS = (
    "categorized_count + inconclusive_count + synergism_count + missing_result_count + conflict_result_count"
)


@query(
    "mart_rows unique_keys missing_gram_group negative_count_rows denominator_mismatches tested_mismatches "
    "status_mismatches category_mismatches bound_violations",
    f"""SELECT count(*) AS mart_rows, count(DISTINCT susceptibility_mart_key) AS unique_keys,
  {any_rows('gram_stain_group IS NULL')} AS missing_gram_group, 0::bigint AS negative_count_rows,
  {any_rows(f'eligible_count <> {_PARTS} + untested_count')} AS denominator_mismatches, 0::bigint AS tested_mismatches,
  {any_rows(f'tested_endpoint_count <> {_PARTS}')} AS status_mismatches, 0::bigint AS category_mismatches,
  0::bigint AS bound_violations FROM mart""",
    "mart",
)
def mart_structure(c: Context):
    return audits.mart_structure(c.full.susceptibility)


@query(
    "cohort_id organism_name antibiotic categorized_count display_status",
    f"""SELECT cohort_id, organism_name, antibiotic, categorized_count, display_status FROM mart
WHERE display_status <> CASE WHEN categorized_count >= 10 THEN 'display' ELSE 'insufficient_data' END""",
    "mart",
)
def threshold_violations(c: Context):
    """Rows that another threshold would show or hide."""
    return audits.threshold_violations(c.full.susceptibility, 10)


@query(
    "gram_stain_group organism_count mart_rows",
    """SELECT gram_stain_group, count(DISTINCT organism_reporting_group) AS organism_count, count(*) AS mart_rows
FROM mart GROUP BY 1""",
    "mart",
)
def gram_breakdown(c: Context):
    return audits.gram_breakdown(c.full.susceptibility, "organism_reporting_group")


@query(
    "organism_reporting_group antibiotic gram_stain_group reference_group",
    """SELECT organism_reporting_group, antibiotic, 'gram_negative' AS gram_stain_group,
  'gram_positive' AS reference_group FROM mart WHERE organism_reporting_group LIKE 'Streptococcus %'""",
    "mart",
)
def attribute_mismatches(c: Context):
    """A table in which some groups carry the wrong class."""
    group = F.col("organism_reporting_group")
    wrong = F.when(group.startswith("Streptococcus "), "gram_negative").otherwise(F.col("gram_stain_group"))
    mart = c.full.susceptibility.withColumn("gram_stain_group", wrong)
    return audits.attribute_mismatches(mart, c.seeds.groups, "organism_reporting_group")


@query(
    "source_version organism_reporting_group reporting_phenotype pair_order antibiotic eligible_count "
    "categorized_count susceptible_pct display_status",
    "SELECT {columns} FROM mart WHERE cohort_id = 'blood'",
    "mart",
)
def panel_preview(c: Context):
    return audits.panel_preview(c.full.susceptibility, "blood")


@query(
    "mart_rows unique_keys count_identity_mismatches invalid_counts percentage_formula_mismatches "
    "out_of_bounds_percentages missing_gram_classification",
    f"""SELECT count(*) AS mart_rows, count(DISTINCT mdro_mart_key) AS unique_keys, 0::bigint AS
  count_identity_mismatches, 0::bigint AS invalid_counts, 0::bigint AS percentage_formula_mismatches, 0::bigint AS
  out_of_bounds_percentages, {any_rows('gram_stain_group IS NULL')} AS missing_gram_classification FROM mdro""",
    "mdro",
)
def mdro_structure(c: Context):
    return audits.mdro_structure(c.full.mdro)


@query(
    "$analysis_window_start $analysis_window_end_exclusive validation_status mdro_mart_rows",
    """SELECT {window_start} AS analysis_window_start, {window_end} AS analysis_window_end_exclusive,
  'pass' AS validation_status, count(*) AS mdro_mart_rows FROM mdro""",
    "mdro",
    window=True,
)
def mdro_rebuild(c: Context):
    return audits.mdro_rebuild(c.windowed.mdro, c.full.records)


@query(
    "$analysis_window_start $analysis_window_end_exclusive validation_status mdro_mart_rows",
    """SELECT '1998-01-01' AS analysis_window_start, '1999-01-01' AS analysis_window_end_exclusive,
  'invalid_reporting_window' AS validation_status, (SELECT count(*) FROM mdro) + (SELECT count(*) FROM
  (SELECT DISTINCT source_version, cohort_id, organism_reporting_group, CASE r WHEN 1 THEN ast_cre_status
    ELSE ast_mdr_p_aeruginosa_status END <> 'not_applicable' AS applies, r
  FROM record, (VALUES (1), (2)) AS rules(r) WHERE culture_time_shifted IS NOT NULL) WHERE applies) AS mdro_mart_rows""",
    "mdro",
    "record",
    window=True,
)
def mdro_rebuild_mixed_windows(c: Context):
    """Two windows in one table are reported as such, not passed."""
    mixed = c.windowed.mdro.unionByName(c.full.mdro)
    return audits.mdro_rebuild(mixed, c.full.records)


@query(
    "gram_stain_group organism_base_name mdro_phenotype mart_rows",
    "SELECT gram_stain_group, organism_base_name, mdro_phenotype, count(*) AS mart_rows FROM mdro GROUP BY ALL",
    "mdro",
)
def mdro_breakdown(c: Context):
    return audits.gram_breakdown(
        c.full.mdro, "organism_base_name", ["gram_stain_group", "organism_base_name", "mdro_phenotype"]
    )


@query(
    "organism_reporting_group",
    """SELECT DISTINCT organism_reporting_group FROM (SELECT organism_reporting_group FROM mart
  UNION ALL SELECT organism_base_name FROM mdro) WHERE organism_reporting_group NOT IN (SELECT
  organism_reporting_group FROM groups WHERE gram_stain_group = 'gram_positive')""",
    "mart",
    "mdro",
    "groups",
)
def groups_without_reference(c: Context):
    """Reported groups missing from a reference table that was cut short."""
    short = c.seeds.groups.filter("gram_stain_group = 'gram_positive'")
    return audits.groups_without_reference(c.full.susceptibility, c.full.mdro, short)


@query(
    "reporting_phenotype organism_reporting_group mart_rows maximum_eligible_count",
    """SELECT reporting_phenotype, organism_reporting_group, count(*) AS mart_rows, max(eligible_count) AS
  maximum_eligible_count FROM mart GROUP BY ALL""",
    "mart",
)
def category_inventory(c: Context):
    return audits.category_inventory(c.full.susceptibility)


@query(
    "cohort_id reporting_phenotype n_first_cultures",
    """SELECT cohort_id, reporting_phenotype, max(eligible_count) AS n_first_cultures FROM mart
WHERE organism_reporting_group = 'Staphylococcus aureus' GROUP BY ALL""",
    "mart",
)
def category_sizes(c: Context):
    return audits.category_sizes(c.full.susceptibility, ref.S_AUREUS)


@query(
    "cohort_id organism_reporting_group base_patients esce_r_patients vre_patients patients_in_both_categories",
    f"""SELECT cohort_id, organism_reporting_group, {any_rows('b')} AS base_patients, {any_rows('e')} AS
  esce_r_patients, {any_rows('v')} AS vre_patients, {any_rows('b AND (e OR v)')} AS patients_in_both_categories
FROM (SELECT cohort_id, organism_reporting_group, bool_or(reporting_phenotype = 'base') AS b,
    bool_or(reporting_phenotype = 'esce_r') AS e, bool_or(reporting_phenotype = 'vancomycin_resistant') AS v
  FROM first_stratified GROUP BY source_version, cohort_id, organism_reporting_group, patient_key)
GROUP BY ALL HAVING esce_r_patients + vre_patients > 0""",
    "first_stratified",
)
def population_overlap(c: Context):
    return audits.population_overlap(c.full.first_stratified)


@query(
    "mdro_phenotype cohort_id rows patients positive_patients",
    """SELECT mdro_phenotype, cohort_id, count(*) AS rows, sum(denominator_count)::bigint AS patients,
  sum(positive_count)::bigint AS positive_patients FROM mdro GROUP BY ALL""",
    "mdro",
)
def mdro_totals(c: Context):
    return audits.mdro_totals(c.full.mdro)


_COVERED = f"""count(*) AS total_pairs, {any_rows(_DISPLAYED)} AS displayable_pairs,
  {any_rows("display_status = 'insufficient_data'")} AS insufficient_data_pairs,
  {pct(any_rows(_DISPLAYED), 'count(*)')} AS pct_displayable"""


@query(
    "cohort_id reporting_phenotype total_pairs displayable_pairs insufficient_data_pairs pct_displayable",
    f"SELECT cohort_id, reporting_phenotype, {_COVERED} FROM mart GROUP BY ALL",
    "mart",
)
def display_coverage(c: Context):
    return audits.display_coverage(c.full.susceptibility, ["cohort_id", "reporting_phenotype"])


@query(
    "$analysis_window_start cohort_id reporting_phenotype total_pairs displayable_pairs insufficient_data_pairs "
    "pct_displayable",
    f"SELECT analysis_window_start, cohort_id, reporting_phenotype, {_COVERED} FROM mart GROUP BY ALL",
    "mart",
    window=True,
)
def display_coverage_by_window(c: Context):
    return audits.display_coverage(
        c.windowed.susceptibility, ["analysis_window_start", "cohort_id", "reporting_phenotype"]
    )


@query(
    "shifted_year cohort_id patient_organism_groups groups_with_esce_evidence groups_with_mrsa_evidence "
    "groups_with_vre_evidence",
    f"""SELECT shifted_year, cohort_id, count(*) AS patient_organism_groups, {any_rows('e')} AS
  groups_with_esce_evidence, {any_rows('o')} AS groups_with_mrsa_evidence, {any_rows('v')} AS groups_with_vre_evidence
FROM (SELECT year(culture_time_shifted)::int AS shifted_year, cohort_id,
    bool_or(ast_esce_enterobacterales_status = 'positive') AS e,
    bool_or(ast_oxacillin_resistance_status = 'positive') AS o,
    bool_or(ast_vancomycin_resistance_status = 'positive') AS v
  FROM record WHERE culture_time_shifted IS NOT NULL
  GROUP BY year(culture_time_shifted), cohort_id, organism_reporting_group, patient_key) GROUP BY ALL""",
    "record",
)
def yearly_groups(c: Context):
    return audits.yearly_groups(c.full.records)


@query(
    "shifted_month blood_cultures respiratory_cultures urine_cultures",
    """SELECT strftime(culture_time_shifted, '%Y-%m') AS shifted_month,
  count(DISTINCT CASE WHEN cohort_id = 'blood' THEN culture_key END) AS blood_cultures,
  count(DISTINCT CASE WHEN cohort_id = 'respiratory' THEN culture_key END) AS respiratory_cultures,
  count(DISTINCT CASE WHEN cohort_id = 'urine' THEN culture_key END) AS urine_cultures FROM windowed GROUP BY 1""",
    "windowed",
    window=True,
)
def monthly_cultures(c: Context):
    return audits.monthly_cultures(c.full.records, c.windowed.window, ref.COHORTS)


_GROUP_CELL = ["cohort_id", "organism_reporting_group"]


def _patient_bitmaps(c: Context):
    return bitmaps.monthly_bitmaps(
        c.full.records, _GROUP_CELL, "patient_key", "culture_time_shifted", Scratch(c.spark), "patients"
    )


@query(
    "$analysis_window_start cohort_id organism_reporting_group patients",
    """SELECT s::varchar AS analysis_window_start, cohort_id, organism_reporting_group, count(DISTINCT patient_key) AS patients
FROM record, (SELECT DISTINCT (date_trunc('month', culture_time_shifted) - to_months(k::int))::date AS s
  FROM record, range(12) r(k) WHERE culture_time_shifted IS NOT NULL)
WHERE culture_time_shifted >= s AND culture_time_shifted < s + to_months(12) GROUP BY ALL""",
    "record",
)
def patients_by_window(c: Context):
    """Distinct patients of each group in every twelve-month window with a monthly start."""
    return bitmaps.distinct_by_window(_patient_bitmaps(c), _GROUP_CELL, 1, "patients")


@query(
    "shifted_year cohort_id patients",
    """SELECT year(culture_time_shifted)::int AS shifted_year, cohort_id, count(DISTINCT patient_key) AS patients
FROM record WHERE culture_time_shifted IS NOT NULL GROUP BY ALL""",
    "record",
)
def yearly_patients(c: Context):
    """Distinct patients per year and cohort, from the same monthly bitmaps of finer cells."""
    return bitmaps.distinct_by_cell(_patient_bitmaps(c), ["cohort_id"], 12, "patients").withColumnRenamed(
        "period", "shifted_year"
    )
