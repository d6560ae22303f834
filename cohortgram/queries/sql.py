"""The relations of a report in plain SQL, written apart from the operators, to check their results.

`compose("SELECT …", "mart")` puts the named relation and everything it needs into a WITH clause.
"""

from __future__ import annotations

import re

from cohortgram import reference as ref
from cohortgram.operators import audits
from cohortgram.queries import source

KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(columns: str, rows) -> str:
    body = ",\n  ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES\n  {body}) AS t({columns})"


def key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} AS varchar), '{KEY_TOKEN}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def pct(part: str, whole: str) -> str:
    return f"cast(round(100.0 * ({part}) / nullif({whole}, 0), 1) AS double)"


def any_rows(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def like_any(column: str, patterns) -> str:
    return "(" + " OR ".join(f"{column} LIKE '{p}'" for p in patterns) + ")"


def in_list(items) -> str:
    return "(" + ", ".join(literal(i) for i in items) + ")"


ORDER = "source_version, patient_key, encounter_key, culture_order_key"
STATUSES = ref.STATUS_COLUMNS


def window_condition(start: str) -> str:
    end = f"TIMESTAMP '{start}' + INTERVAL 12 MONTH"
    return f"culture_time_shifted >= TIMESTAMP '{start}' AND culture_time_shifted < {end}"


WINDOW = window_condition(source.WINDOW_START)

_CASE_MODE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in source.ORDERING_MODES.items())
_CASE_DESCRIPTION = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in source.DESCRIPTIONS.items())
_RELEASE = "CASE WHEN o_orderstatus = 'O' THEN '2025-10-01' ELSE '2025-04-11' END"
_IDS = """'P' || o_custkey AS anon_id,
    'V' || o_custkey || '-' || year(o_orderdate) AS pat_enc_csn_id_coded,
    'C' || o_custkey || '-' || year(o_orderdate) || 'Q' || quarter(o_orderdate) AS order_proc_id_coded"""
_TIME = """CASE WHEN o_orderkey % 97 = 0 THEN 'time unknown'
      ELSE strftime(o_orderdate + to_hours(o_orderkey % 24), '%Y-%m-%d %H:%M:%S') END"""
_INGEST = f"""'cultures_' || year(o_orderdate) || '.csv' AS source_file,
    {_RELEASE} AS source_version,
    cast({_RELEASE} || ' 06:00:00' AS timestamp) AS ingested_at"""


def _merge_status(column: str) -> str:
    """The strongest status of a group: list every status, then look for them in order."""
    found = f"list({column})"
    return (
        f"CASE WHEN list_contains({found}, 'positive') THEN 'positive' "
        f"WHEN list_contains({found}, 'not_evaluable') THEN 'not_evaluable' "
        f"WHEN list_contains({found}, 'not_detected') THEN 'not_detected' ELSE 'not_applicable' END"
    )


# Fixed values, written out here as well so that a wrong rule shows: what each rule applies to, and its drugs.
_SCOPES = """
    CASE WHEN organism_standardized = 'Morganella morganii' OR organism_standardized LIKE 'Proteus %'
        OR upper(organism_source) LIKE 'MORGANELLA MORGANII%' OR upper(organism_source) LIKE 'PROTEUS %'
      THEN 'proteus_morganella'
      WHEN organism_standardized IN ('Escherichia coli', 'Serratia marcescens')
        OR regexp_matches(organism_standardized, '^(Citrobacter|Enterobacter|Klebsiella) ')
        OR regexp_matches(upper(organism_source), '^(CITROBACTER |ZZZCITROBACTER |ENTEROBACTER |ESCHERICHIA COLI|KLEBSIELLA |SERRATIA MARCESCENS)')
      THEN 'standard' END AS cre_scope,
    CASE WHEN organism_standardized = 'Pseudomonas aeruginosa' THEN 'eligible' END AS mdr_scope,
    CASE WHEN organism_standardized = 'Staphylococcus aureus' THEN 'eligible' END AS oxacillin_scope,
    CASE WHEN organism_standardized IN ('Enterococcus faecalis', 'Enterococcus faecium') THEN 'eligible' END AS vre_scope,
    CASE WHEN organism_standardized IN ('Escherichia coli', 'Klebsiella aerogenes', 'Klebsiella oxytoca',
        'Klebsiella pneumoniae') OR organism_standardized LIKE 'Enterobacter %'
        OR regexp_matches(upper(organism_source), '^(ESCHERICHIA COLI|KLEBSIELLA AEROGENES|KLEBSIELLA OXYTOCA|KLEBSIELLA PNEUMONIAE|ENTEROBACTER )')
      THEN 'eligible' END AS esce_scope"""
_RULE_DRUGS = (
    ("cre", "cre", "standard", 0, "Ertapenem, Imipenem, Meropenem, Meropenem/Vaborbactam, Imipenem/Relebactam"),
    ("cre", "cre", "proteus_morganella", 0, "Ertapenem, Meropenem, Meropenem/Vaborbactam"),
    ("mdr", "mdr_es_ceph", "eligible", 1, "Cefepime, Ceftazidime, Ceftazidime/Avibactam, Ceftolozane/Tazobactam"),
    ("mdr", "mdr_fq", "eligible", 1, "Ciprofloxacin, Levofloxacin"),
    ("mdr", "mdr_aminoglycoside", "eligible", 1, "Tobramycin"),
    ("mdr", "mdr_carbapenem", "eligible", 1, "Imipenem, Meropenem, Imipenem/Relebactam"),
    ("mdr", "mdr_piptazo", "eligible", 1, "Piperacillin/Tazobactam"),
    ("mdr", "mdr_cefiderocol", "eligible", 1, "Cefiderocol"),
    ("oxacillin", "oxacillin", "eligible", 0, "Oxacillin, Cefoxitin"),
    ("vre", "vre", "eligible", 0, "Vancomycin"),
    (
        "esce",
        "esce",
        "eligible",
        0,
        "Cefepime, Ceftriaxone, Cefotaxime, Ceftazidime, Ceftazidime/Avibactam, Ceftolozane/Tazobactam",
    ),
)
_RULE_ROWS = [(r, c, scope, drug, i) for r, c, scope, i, drugs in _RULE_DRUGS for drug in drugs.split(", ")]
_GRAM = """SELECT DISTINCT organism_reporting_group, CASE WHEN organism_reporting_group LIKE 'Enterococcus %'
    OR organism_reporting_group LIKE 'Staphylococcus %' OR organism_reporting_group LIKE 'Streptococcus %'
    OR organism_reporting_group LIKE 'Coagulase-negative %' THEN 'gram_positive' ELSE 'gram_negative' END AS gram_stain_group
  FROM labels"""
_SINGLE = [r for r in ref.RULES if r.needed is None]


def _marker(rule: ref.Rule) -> str:
    return f"""CASE WHEN {rule.name}_scope IS NULL THEN 'not_applicable'
      WHEN {rule.name}_pos > 0 THEN 'positive' WHEN {rule.name}_unk > 0 THEN 'not_evaluable'
      WHEN {rule.name}_neg > 0 THEN 'not_detected' ELSE 'not_evaluable' END AS {rule.status}"""


def _category(evidence: ref.Evidence) -> str:
    n = evidence.name
    return f"""CASE WHEN mdr_scope IS NULL THEN 'not_applicable'
      WHEN {n}_pos > 0 THEN 'positive' WHEN {n}_unk > 0 THEN 'not_evaluable'
      WHEN {n}_neg > 0 THEN 'observed_non_positive' ELSE 'not_tested' END AS {n}_status"""


_CATEGORY_NAMES = [f"{e.name}_status" for e in ref.MDR.evidence]
_POSITIVE_CATEGORIES = " + ".join(f"({c} = 'positive')::int" for c in _CATEGORY_NAMES)
_UNKNOWN_CATEGORIES = " + ".join(f"({c} IN ('not_evaluable', 'not_tested'))::int" for c in _CATEGORY_NAMES)

RESULT_COUNTS = f"""
    count(resolution_status) AS tested_endpoint_count,
    {any_rows("resolution_status = 'resolved' AND susceptibility IN ('Susceptible', 'Resistant', 'Intermediate')")}
      AS categorized_count,
    {any_rows("resolution_status = 'resolved' AND susceptibility = 'Susceptible'")} AS susceptible_count,
    {any_rows("resolution_status = 'resolved' AND susceptibility = 'Resistant'")} AS resistant_count,
    {any_rows("resolution_status = 'resolved' AND susceptibility = 'Intermediate'")} AS intermediate_count,
    {any_rows("resolution_status = 'resolved' AND susceptibility = 'Inconclusive'")} AS inconclusive_count,
    {any_rows("resolution_status = 'resolved' AND susceptibility = 'Synergism'")} AS synergism_count,
    {any_rows("resolution_status = 'missing'")} AS missing_result_count,
    {any_rows("resolution_status = 'conflict'")} AS conflict_result_count"""

GRID_BLOCKED = """EXISTS (SELECT 1 FROM exclusions e
    WHERE e.organism_reporting_group = g.organism_reporting_group AND e.antibiotic = g.antibiotic
      AND e.cohort_id IN ('*', g.cohort_id) AND e.reporting_phenotype IN ('*', g.reporting_phenotype))"""


def _group_endpoints(groups: str) -> str:
    return f"""
  SELECT ast_scope, reporting_source_key, source_version, cohort_id, patient_key, organism_reporting_group,
    antibiotic, n AS source_endpoint_row_count, n AS source_organisms_with_endpoint, conflicts AS source_conflict_count,
    missings AS source_missing_count, len(found)::bigint AS distinct_resolved_result_count,
    found AS resolved_results, states AS source_resolution_statuses,
    CASE WHEN conflicts > 0 OR len(found) > 1 THEN 'conflict' WHEN len(found) = 1 THEN 'resolved'
      ELSE 'missing' END AS resolution_status,
    CASE WHEN conflicts = 0 AND len(found) = 1 THEN found[1] END AS susceptibility,
    CASE WHEN conflicts > 0 THEN 'source_endpoint_conflict' WHEN len(found) > 1 THEN 'discordant_source_results'
      WHEN len(found) = 1 AND missings > 0 THEN 'resolved_with_missing_source_endpoint'
      WHEN len(found) = 1 THEN 'resolved_consistent_result' ELSE 'missing_only' END AS reconciliation_reason
  FROM (
    SELECT ast_scope, reporting_source_key, x.source_version, x.cohort_id, x.patient_key,
      x.organism_reporting_group, e.antibiotic, count(*) AS n,
      {any_rows("e.resolution_status = 'conflict'")} AS conflicts,
      {any_rows("e.resolution_status = 'missing'")} AS missings,
      coalesce(list_sort(list(DISTINCT e.susceptibility) FILTER (WHERE e.resolution_status = 'resolved')), []) AS found,
      list_sort(list(DISTINCT e.resolution_status)) AS states
    FROM ({groups}) x JOIN endpoint e ON list_contains(x.members, e.culture_organism_key)
    GROUP BY ALL)"""


_MEMBER_GROUPS = """
      SELECT 'overall' AS ast_scope, reporting_culture_observation_key AS reporting_source_key, source_version,
        cohort_id, patient_key, organism_reporting_group, unnest(source_culture_organism_keys) AS member
      FROM observation WHERE organism_reporting_group = 'Staphylococcus aureus'
      UNION ALL
      SELECT 'stratified', reporting_culture_organism_key, source_version, cohort_id, patient_key,
        organism_reporting_group, unnest(source_culture_organism_keys)
      FROM windowed WHERE reporting_phenotype IN ('base', 'esce_r', 'oxacillin_resistant', 'vancomycin_resistant')"""

RELATIONS = {
    "labels": values(
        "organism_source, organism_standardized, organism_reporting_group, source_qualifier, "
        "include_primary_summary, mapping_status",
        [row[:6] for row in ref.label_rows()],
    ),
    "groups": _GRAM,
    "pairs": values(", ".join(ref.PAIR_COLUMNS), ref.pair_rows()),
    "active": """SELECT organism_reporting_group, cohort_id, antibiotic, pair_order FROM pairs
  WHERE include_primary_dashboard = 1 AND review_status = 'reviewed'""",
    "exclusions": values(
        "organism_reporting_group, cohort_id, reporting_phenotype, antibiotic, exclusion_reason, review_basis",
        [row[:6] for row in ref.exclusion_rows()],
    ),
    "rules": values("rule, category, scope, drug, i_counts", _RULE_ROWS),
    "picks": values(
        "pick, label, panel", [(i, l, p) for i, (l, p) in enumerate(zip(source.LABELS, source.PANEL_OF_LABEL))]
    ),
    "panel": values(
        "panel, slot, drug", [(p, i, d) for p, drugs in source.PANEL_DRUGS.items() for i, d in enumerate(drugs)]
    ),
    "raw": f"""
  SELECT {_IDS},
    {_TIME} AS order_time_jittered_utc,
    CASE o_orderpriority {_CASE_MODE} ELSE 'Outpatient' END AS ordering_mode,
    CASE c_nationkey WHEN 0 THEN lower(description) WHEN 1 THEN ' ' || description ELSE description END
      AS culture_description,
    CASE WHEN negative THEN '0' WHEN o_orderkey % 89 = 0 THEN '1.0' ELSE '1' END AS was_positive,
    CASE WHEN negative THEN 'Null' ELSE picks.label END AS organism,
    CASE WHEN negative OR l_tax >= 0.08 THEN 'Null' ELSE panel.drug END AS antibiotic,
    CASE WHEN negative OR l_tax >= 0.08 THEN 'Null'
      WHEN l_returnflag = 'R' AND l_quantity <= 25 THEN 'Resistant'
      WHEN l_returnflag = 'N' AND l_quantity <= 3 THEN 'Null'
      WHEN l_returnflag = 'N' AND l_quantity <= 5 THEN ' Null '
      WHEN l_returnflag = 'N' AND l_quantity <= 8 THEN 'Inconclusive'
      WHEN l_returnflag = 'N' AND l_quantity <= 10 THEN 'Synergism'
      WHEN l_returnflag = 'N' AND l_quantity <= 25 THEN 'Intermediate'
      ELSE 'Susceptible' END AS susceptibility,
    {_INGEST}
  FROM (
    SELECT *, o_orderpriority = '5-LOW' AS negative,
      CASE c_mktsegment {_CASE_DESCRIPTION} END AS description,
      (o_custkey * 3 + year(o_orderdate) % 2
        + CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 1 ELSE 0 END) % {len(source.LABELS)} AS p
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey) x
  JOIN picks ON picks.pick = x.p
  JOIN panel ON panel.panel = picks.panel AND panel.slot = x.l_suppkey % {source.DRUGS_PER_PANEL}""",
    "raw_demographics": f"""
  SELECT DISTINCT {_IDS},
    CASE WHEN c_acctbal < 0 THEN ' Null ' WHEN c_acctbal >= 8000 THEN 'above 90'
      ELSE cast(floor(c_acctbal / 2000) * 20 AS int) || '-' || cast(floor(c_acctbal / 2000) * 20 + 19 AS int) || ' years'
    END AS age,
    CASE WHEN c_nationkey % 5 = 4 THEN 'Null' ELSE cast(c_nationkey % 2 AS varchar) END AS gender,
    'demographics.csv' AS source_file, {_RELEASE} AS source_version,
    cast({_RELEASE} || ' 06:00:00' AS timestamp) AS ingested_at
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "raw_ward": f"""
  SELECT {_IDS}, {_TIME} AS order_time_jittered_utc,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1' ELSE '0' END AS hosp_ward_IP,
    CASE WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN '1' ELSE '0' END AS hosp_ward_OP,
    CASE WHEN o_totalprice > 250000 THEN '1' ELSE '0' END AS hosp_ward_ER,
    CASE WHEN o_totalprice > 400000 AND o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END AS hosp_ward_ICU,
    'ward.csv' AS source_file, {_RELEASE} AS source_version,
    cast({_RELEASE} || ' 06:00:00' AS timestamp) AS ingested_at
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "staged": """
  SELECT anon_id AS patient_key, pat_enc_csn_id_coded AS encounter_key, order_proc_id_coded AS culture_order_key,
    order_time_jittered_utc AS order_time_jittered_utc_raw,
    try_cast(order_time_jittered_utc AS timestamp) AS culture_time_shifted,
    nullif(trim(ordering_mode), 'Null') AS ordering_mode,
    nullif(trim(culture_description), 'Null') AS culture_description,
    CASE WHEN regexp_full_match(trim(was_positive), '[+-]?[0-9]+') THEN cast(was_positive AS int) END AS was_positive,
    nullif(trim(organism), 'Null') AS organism,
    nullif(trim(antibiotic), 'Null') AS antibiotic,
    susceptibility AS susceptibility_raw,
    CASE WHEN susceptibility <> 'Null' THEN trim(susceptibility) END AS susceptibility,
    source_file, source_version, ingested_at
  FROM raw""",
    "demographics": """
  SELECT anon_id AS patient_key, pat_enc_csn_id_coded AS encounter_key, order_proc_id_coded AS culture_order_key,
    age AS age_raw, gender AS gender_raw, nullif(trim(age), 'Null') AS age, nullif(trim(gender), 'Null') AS gender,
    source_file, source_version, ingested_at
  FROM raw_demographics""",
    "ward": """
  SELECT anon_id AS patient_key, pat_enc_csn_id_coded AS encounter_key, order_proc_id_coded AS culture_order_key,
    order_time_jittered_utc AS order_time_jittered_utc_raw,
    try_cast(order_time_jittered_utc AS timestamp) AS culture_time_shifted,
    cast(hosp_ward_IP AS int) AS hosp_ward_ip, cast(hosp_ward_OP AS int) AS hosp_ward_op,
    cast(hosp_ward_ER AS int) AS hosp_ward_er, cast(hosp_ward_ICU AS int) AS hosp_ward_icu,
    source_file, source_version, ingested_at
  FROM raw_ward""",
    "culture": f"""
  SELECT {key(*ORDER.split(', '))} AS culture_key, {ORDER},
    CASE WHEN t = 1 THEN any_time END AS culture_time_shifted,
    CASE WHEN m = 1 THEN any_mode END AS ordering_mode,
    CASE WHEN d = 1 THEN any_description END AS culture_description,
    CASE WHEN p = 1 THEN any_positive END AS was_positive,
    greatest(t, m, d, p) > 1 AS has_order_level_conflict,
    source_row_count, source_file, ingested_at
  FROM (
    SELECT {ORDER}, count(*) AS source_row_count,
      count(DISTINCT coalesce(cast(culture_time_shifted AS varchar), '?')) AS t, min(culture_time_shifted) AS any_time,
      count(DISTINCT coalesce(ordering_mode, '?')) AS m, min(ordering_mode) AS any_mode,
      count(DISTINCT coalesce(culture_description, '?')) AS d, min(culture_description) AS any_description,
      count(DISTINCT coalesce(cast(was_positive AS varchar), '?')) AS p, min(was_positive) AS any_positive,
      max(source_file) AS source_file, max(ingested_at) AS ingested_at
    FROM staged GROUP BY {ORDER})""",
    "culture_organism": f"""
  SELECT {key('c.culture_key', 'o.organism')} AS culture_organism_key, c.culture_key, o.*,
    antibiotic_result_row_count > distinct_antibiotic_count AS has_repeated_antibiotic_records
  FROM (
    SELECT {ORDER}, organism, count(*) AS source_row_count, count(antibiotic) AS antibiotic_result_row_count,
      count(DISTINCT antibiotic) AS distinct_antibiotic_count,
      max(source_file) AS source_file, max(ingested_at) AS ingested_at
    FROM staged WHERE organism IS NOT NULL GROUP BY {ORDER}, organism) o
  JOIN culture c USING ({ORDER})""",
    "endpoint": f"""
  SELECT co.culture_organism_key, co.culture_key, g.*,
    greatest(g.source_row_count - distinct_result_state_count, 0) AS repeated_result_row_count,
    CASE WHEN len(found) = 1 AND missing_susceptibility_row_count = 0 THEN 'resolved'
      WHEN len(found) = 0 THEN 'missing' ELSE 'conflict' END AS resolution_status,
    CASE WHEN len(found) = 1 AND missing_susceptibility_row_count = 0 THEN found[1] END AS susceptibility
  FROM (
    SELECT {ORDER}, organism, antibiotic, count(*) AS source_row_count,
      count(*) - count(susceptibility) AS missing_susceptibility_row_count,
      count(DISTINCT susceptibility) AS distinct_nonnull_category_count,
      count(DISTINCT susceptibility) + CASE WHEN count(*) > count(susceptibility) THEN 1 ELSE 0 END
        AS distinct_result_state_count,
      coalesce(list_sort(list(DISTINCT susceptibility) FILTER (WHERE susceptibility IS NOT NULL)), []) AS found,
      max(source_file) AS source_file, max(ingested_at) AS ingested_at
    FROM staged WHERE organism IS NOT NULL AND antibiotic IS NOT NULL
    GROUP BY {ORDER}, organism, antibiotic) g
  JOIN culture_organism co USING ({ORDER}, organism)""",
    "dimension": f"""
  SELECT {key('v.organism_source')} AS organism_source_key, v.organism_source, l.organism_standardized,
    nullif(trim(l.organism_reporting_group), '') AS organism_reporting_group,
    nullif(trim(l.source_qualifier), '') AS source_qualifier,
    coalesce(l.include_primary_summary, 0) AS include_primary_summary,
    CASE WHEN l.organism_source IS NULL THEN 'unmapped' ELSE l.mapping_status END AS mapping_status,
    l.organism_source IS NOT NULL AS has_reviewed_mapping
  FROM (SELECT DISTINCT organism AS organism_source FROM culture_organism) v
  LEFT JOIN labels l USING (organism_source)""",
    "cohort_record": f"""
  SELECT co.culture_organism_key, co.culture_key, {', '.join('co.' + c for c in ORDER.split(', '))}, co.organism,
    c.culture_time_shifted, c.culture_description, c.was_positive, lower(c.culture_description) AS cohort_id
  FROM culture_organism co JOIN culture c USING (culture_key)
  WHERE c.culture_description IN ('BLOOD', 'URINE', 'RESPIRATORY')""",
    "mapped": """
  SELECT r.* EXCLUDE (organism), d.* FROM cohort_record r JOIN dimension d ON r.organism = d.organism_source""",
    "scoped": f"\n  SELECT *, {_SCOPES}\n  FROM mapped",
    "evidence": """
  SELECT s.culture_organism_key, r.category,
    count(*) FILTER (WHERE judged AND (e.susceptibility = 'Resistant'
      OR (i_counts = 1 AND e.susceptibility = 'Intermediate'))) AS pos,
    count(*) FILTER (WHERE judged AND (e.susceptibility = 'Susceptible'
      OR (i_counts = 0 AND e.susceptibility = 'Intermediate'))) AS neg,
    count(*) FILTER (WHERE NOT judged) AS unk
  FROM scoped s
  JOIN (SELECT *, resolution_status = 'resolved' AND susceptibility IN ('Susceptible', 'Intermediate', 'Resistant')
        AS is_judged FROM endpoint) e USING (culture_organism_key)
  JOIN rules r ON r.drug = e.antibiotic AND r.scope = CASE r.rule WHEN 'cre' THEN cre_scope WHEN 'mdr' THEN mdr_scope
    WHEN 'oxacillin' THEN oxacillin_scope WHEN 'vre' THEN vre_scope WHEN 'esce' THEN esce_scope END
  CROSS JOIN LATERAL (SELECT coalesce(e.is_judged, false) AS judged)
  GROUP BY ALL""",
    "evidence_wide": "\n  SELECT culture_organism_key, "
    + ",\n    ".join(
        f"coalesce(sum({part}) FILTER (WHERE category = '{e.name}'), 0)::bigint AS {e.name}_{part}"
        for r in ref.RULES
        for e in r.evidence
        for part in ("pos", "neg", "unk")
    )
    + "\n  FROM evidence GROUP BY culture_organism_key",
    "judged": "\n  SELECT s.*, "
    + ", ".join(f"w.{e.name}_{part}" for r in ref.RULES for e in r.evidence for part in ("pos", "neg", "unk"))
    + ",\n    "
    + ",\n    ".join([_marker(r) for r in _SINGLE] + [_category(e) for e in ref.MDR.evidence])
    + "\n  FROM scoped s LEFT JOIN evidence_wide w USING (culture_organism_key)",
    "phenotype": f"""
  SELECT *, CASE WHEN mdr_scope IS NULL THEN 'not_applicable' WHEN positives >= 3 THEN 'positive'
      WHEN positives + unknowns < 3 THEN 'not_detected' ELSE 'not_evaluable' END AS ast_mdr_p_aeruginosa_status,
    (source_qualifier IS NOT NULL AND lower(source_qualifier) = 'carbapenem_resistant')
      OR upper(organism_source) LIKE '%CARBAPENEM RESISTANT%' AS source_designated_cre,
    (source_qualifier IS NOT NULL AND upper(source_qualifier) = 'MRSA')
      OR upper(organism_source) LIKE '%MRSA%' AS source_designated_mrsa,
    (source_qualifier IS NOT NULL AND lower(source_qualifier) = 'vancomycin_resistant')
      OR upper(organism_source) LIKE '%VANCO RESISTANT%' AS source_designated_vre
  FROM (SELECT *, {_POSITIVE_CATEGORIES} AS positives, {_UNKNOWN_CATEGORIES} AS unknowns FROM judged)""",
    "categorised": """
  SELECT *, CASE WHEN ast_cre_status = 'positive' THEN 'cre'
      WHEN ast_mdr_p_aeruginosa_status = 'positive' THEN 'mdr_p_aeruginosa'
      WHEN ast_oxacillin_resistance_status = 'positive' THEN 'oxacillin_resistant'
      WHEN ast_vancomycin_resistance_status = 'positive' THEN 'vancomycin_resistant'
      WHEN ast_esce_enterobacterales_status = 'positive' THEN 'esce_r' ELSE 'base' END AS reporting_phenotype,
    organism_reporting_group || CASE WHEN ast_oxacillin_resistance_status = 'positive' THEN ' — oxacillin resistant'
      WHEN ast_vancomycin_resistance_status = 'positive' THEN ' — vancomycin resistant'
      WHEN ast_esce_enterobacterales_status = 'positive' AND ast_cre_status <> 'positive'
        THEN ' — extended-spectrum cephalosporin resistant' ELSE '' END AS organism_name
  FROM phenotype
  WHERE include_primary_summary = 1 AND mapping_status = 'reviewed' AND organism_reporting_group IS NOT NULL""",
    "record": f"""
  SELECT {key('source_version', 'cohort_id', 'culture_key', 'organism_reporting_group', 'reporting_phenotype')}
      AS reporting_culture_organism_key,
    source_version, patient_key, encounter_key, culture_order_key, cohort_id, culture_key, culture_time_shifted,
    culture_description, was_positive, organism_reporting_group, organism_name, reporting_phenotype,
    count(*) AS source_organism_record_count,
    count(DISTINCT organism_source) AS source_label_count,
    count(DISTINCT organism_standardized) AS standardized_identity_count,
    list_sort(list(DISTINCT culture_organism_key)) AS source_culture_organism_keys,
    list_sort(list(DISTINCT organism_source)) AS source_labels,
    list_sort(list(DISTINCT organism_standardized)) AS standardized_identities,
    coalesce(list_sort(list(DISTINCT source_qualifier) FILTER (WHERE source_qualifier IS NOT NULL)), [])
      AS source_qualifiers,
    {', '.join(f'{_merge_status(s)} AS {s}' for s in STATUSES)},
    bool_or(source_designated_cre) AS source_designated_cre,
    bool_or(source_designated_mrsa) AS source_designated_mrsa,
    bool_or(source_designated_vre) AS source_designated_vre
  FROM categorised
  GROUP BY source_version, patient_key, encounter_key, culture_order_key, cohort_id, culture_key,
    culture_time_shifted, culture_description, was_positive, organism_reporting_group, organism_name,
    reporting_phenotype""",
    "windowed": "SELECT * FROM record WHERE culture_time_shifted IS NOT NULL AND {window}",
    "observation": f"""
  SELECT {key('source_version', 'cohort_id', 'culture_key', 'organism_reporting_group')}
      AS reporting_culture_observation_key,
    source_version, cohort_id, patient_key, organism_reporting_group, culture_key,
    min(culture_time_shifted) AS culture_time_shifted,
    list_sort(list_distinct(flatten(list(source_culture_organism_keys)))) AS source_culture_organism_keys,
    list_sort(list(DISTINCT reporting_phenotype)) AS source_reporting_phenotypes,
    count(DISTINCT reporting_culture_organism_key) AS phenotype_records_on_culture,
    {', '.join(f'{_merge_status(s)} AS {s}' for s in STATUSES)}
  FROM windowed GROUP BY source_version, cohort_id, patient_key, organism_reporting_group, culture_key""",
    "group_endpoint": _group_endpoints(
        f"SELECT ast_scope, reporting_source_key, source_version, cohort_id, patient_key, "
        f"organism_reporting_group, member FROM ({_MEMBER_GROUPS})"
    ).replace("list_contains(x.members, e.culture_organism_key)", "x.member = e.culture_organism_key"),
    "marker": """
  SELECT reporting_source_key, bool_or(resolution_status = 'resolved' AND susceptibility = 'Susceptible') AS any_s,
    bool_or(resolution_status <> 'resolved' OR susceptibility <> 'Susceptible') AS any_other
  FROM group_endpoint WHERE ast_scope = 'stratified' AND antibiotic IN ('Oxacillin', 'Cefoxitin')
  GROUP BY reporting_source_key""",
    "candidate": """
  SELECT w.* REPLACE (c.category AS reporting_phenotype, organism_reporting_group || c.suffix AS organism_name)
  FROM windowed w LEFT JOIN marker m ON w.reporting_culture_organism_key = m.reporting_source_key
  JOIN (VALUES ('base', 'base', ''), ('esce_r', 'esce_r', ' — ESCE-R'),
    ('vancomycin_resistant', 'vancomycin_resistant', ' — VRE'),
    ('oxacillin_resistant', 'oxacillin_resistant', ' — MRSA'),
    ('base', 'oxacillin_susceptible', ' — MSSA')) AS c(source, category, suffix)
    ON c.source = w.reporting_phenotype
  WHERE CASE c.category
    WHEN 'base' THEN organism_reporting_group <> 'Staphylococcus aureus'
    WHEN 'esce_r' THEN ast_cre_status <> 'positive'
    WHEN 'vancomycin_resistant' THEN organism_reporting_group IN ('Enterococcus faecalis', 'Enterococcus faecium')
    WHEN 'oxacillin_resistant' THEN organism_reporting_group = 'Staphylococcus aureus'
    ELSE organism_reporting_group = 'Staphylococcus aureus' AND ast_oxacillin_resistance_status = 'not_detected'
      AND m.any_s AND NOT m.any_other END""",
    "first_stratified": f"""
  SELECT {key('source_version', 'cohort_id', 'patient_key', 'organism_reporting_group', 'reporting_phenotype')}
      AS first_stratified_reporting_culture_key, *
  FROM candidate
  QUALIFY rank() OVER (PARTITION BY source_version, cohort_id, patient_key, organism_reporting_group,
    reporting_phenotype ORDER BY culture_time_shifted, culture_key, reporting_culture_organism_key) = 1""",
    "first_overall": f"""
  SELECT {key('source_version', 'cohort_id', 'patient_key', 'organism_reporting_group')}
      AS overall_reporting_isolate_key, *, organism_reporting_group AS organism_name
  FROM observation WHERE organism_reporting_group = 'Staphylococcus aureus'
  QUALIFY rank() OVER (PARTITION BY source_version, cohort_id, patient_key ORDER BY culture_time_shifted, culture_key) = 1""",
    "stratified_endpoint": """
  SELECT f.first_stratified_reporting_culture_key, f.reporting_phenotype, g.*
  FROM first_stratified f JOIN group_endpoint g
    ON g.reporting_source_key = f.reporting_culture_organism_key AND g.ast_scope = 'stratified'""",
    "overall_endpoint": """
  SELECT f.overall_reporting_isolate_key, g.*
  FROM first_overall f JOIN group_endpoint g
    ON g.reporting_source_key = f.reporting_culture_observation_key AND g.ast_scope = 'overall'""",
    "population": """
  SELECT overall_reporting_isolate_key AS selected_reporting_isolate_key, source_version, cohort_id, patient_key,
    organism_reporting_group, organism_name, 'overall' AS reporting_phenotype FROM first_overall
  UNION ALL
  SELECT first_stratified_reporting_culture_key, source_version, cohort_id, patient_key, organism_reporting_group,
    organism_name, reporting_phenotype FROM first_stratified""",
    "population_endpoint": """
  SELECT overall_reporting_isolate_key AS selected_reporting_isolate_key, 'overall' AS reporting_phenotype,
    antibiotic, resolution_status, susceptibility, reconciliation_reason FROM overall_endpoint
  UNION ALL
  SELECT first_stratified_reporting_culture_key, reporting_phenotype, antibiotic, resolution_status, susceptibility,
    reconciliation_reason FROM stratified_endpoint""",
    "approved": """
  SELECT p.*, a.antibiotic, a.pair_order FROM population p JOIN active a USING (organism_reporting_group, cohort_id)""",
    "grid": f"SELECT * FROM approved g WHERE NOT {GRID_BLOCKED}",
    "attached": """
  SELECT g.*, e.resolution_status, e.susceptibility, e.reconciliation_reason
  FROM grid g LEFT JOIN population_endpoint e USING (selected_reporting_isolate_key, reporting_phenotype, antibiotic)""",
    "cell": f"""
  SELECT source_version, cohort_id, organism_reporting_group, organism_name, reporting_phenotype, antibiotic,
    pair_order, count(*) AS eligible_count, {RESULT_COUNTS},
    {any_rows("resolution_status IS NULL")} AS untested_count
  FROM attached GROUP BY ALL""",
    "mart": f"""
  SELECT {key('source_version', 'cohort_id', 'organism_reporting_group', 'reporting_phenotype', 'antibiotic')}
      AS susceptibility_mart_key, c.*,
    {pct('categorized_count', 'eligible_count')} AS categorized_result_coverage_pct,
    {pct('susceptible_count', 'categorized_count')} AS susceptible_pct,
    {pct('resistant_count', 'categorized_count')} AS resistant_pct,
    CASE WHEN categorized_count >= 30 THEN 'display' ELSE 'insufficient_data' END AS display_status,
    {{window_start}} AS analysis_window_start, {{window_end}} AS analysis_window_end_exclusive, gram_stain_group
  FROM cell c LEFT JOIN groups USING (organism_reporting_group)""",
    "patient": """
  SELECT source_version, cohort_id, patient_key, organism_reporting_group, mdro_phenotype,
    CASE max(CASE status WHEN 'positive' THEN 3 WHEN 'not_evaluable' THEN 2 WHEN 'not_detected' THEN 1 END)
      WHEN 3 THEN 'positive' WHEN 2 THEN 'not_evaluable' WHEN 1 THEN 'not_detected' END AS phenotype_status
  FROM (SELECT *, 'CRE' AS mdro_phenotype, ast_cre_status AS status FROM windowed
    UNION ALL SELECT *, 'MDR Pseudomonas aeruginosa', ast_mdr_p_aeruginosa_status FROM windowed)
  WHERE status <> 'not_applicable' GROUP BY ALL""",
    "mdro": f"""
  SELECT {key('source_version', 'cohort_id', 'organism_base_name', 'mdro_phenotype')} AS mdro_mart_key, s.*,
    positive_count + not_detected_count AS evaluable_count,
    {pct('positive_count', 'denominator_count')} AS phenotype_pct,
    {pct('positive_count + not_detected_count', 'denominator_count')} AS evaluable_pct,
    {{window_start}} AS analysis_window_start, {{window_end}} AS analysis_window_end_exclusive, gram_stain_group
  FROM (SELECT source_version, cohort_id, organism_reporting_group AS organism_base_name, mdro_phenotype,
      count(*) AS denominator_count,
      {any_rows("phenotype_status = 'positive'")} AS positive_count,
      {any_rows("phenotype_status = 'not_detected'")} AS not_detected_count,
      {any_rows("phenotype_status = 'not_evaluable'")} AS not_evaluable_count
    FROM patient GROUP BY ALL) s
  LEFT JOIN groups g ON g.organism_reporting_group = s.organism_base_name""",
}


def compose(select: str, *needs: str, window: str | None = None) -> str:
    """``select`` over the named relations and all they are built from."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in RELATIONS:
            if other != name and re.search(rf"\b(FROM|JOIN)\s+{other}\b", RELATIONS[name]):
                visit(other)
        ordered.append(name)

    for name in needs:
        visit(name)
    end = f"strftime(DATE '{window}' + INTERVAL 12 MONTH, '%Y-%m-%d')"
    bounds = {
        "{window}": window_condition(window) if window else "true",
        "{window_start}": f"'{window}'" if window else "cast(NULL AS varchar)",
        "{window_end}": end if window else "cast(NULL AS varchar)",
    }
    body = ",\n".join(f"{name} AS MATERIALIZED ({RELATIONS[name]})" for name in ordered)
    for mark, text in bounds.items():
        body, select = body.replace(mark, text), select.replace(mark, text)
    return f"WITH {body}\n{select}"


def label_group_case(groups) -> str:
    cases = []
    for name, exact, prefixes in groups:
        tests = [f"organism_source = '{e}'" for e in exact] + [f"organism_source LIKE '{p}%'" for p in prefixes]
        cases.append(f"WHEN {' OR '.join(tests)} THEN '{name}'")
    return "CASE " + " ".join(cases) + " END"


CRE_GROUP = label_group_case(audits.CRE_LABEL_GROUPS)
ESCE_GROUP = label_group_case(audits.ESCE_LABEL_GROUPS)
