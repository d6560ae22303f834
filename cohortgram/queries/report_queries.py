"""Reconciliation, classification, consolidation, selection and the two tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cohortgram import reference as ref
from cohortgram.functions.measures import safe_pct
from cohortgram.functions.statuses import strongest_status, tri_state
from cohortgram.operators import consolidate as con
from cohortgram.operators import evidence as ev
from cohortgram.operators import marts, profile, reconcile
from cohortgram.operators import select as sel
from cohortgram.plans import windows
from cohortgram.queries.context import Context
from cohortgram.queries.registry import query
from cohortgram.queries.sql import RESULT_COUNTS, any_rows, pct

STATUS = " ".join(ref.STATUS_COLUMNS)

# -- reconciliation --------------------------------------------------------------------------------
ENDPOINT = (
    "culture_organism_key culture_key organism antibiotic source_row_count missing_susceptibility_row_count "
    "distinct_nonnull_category_count distinct_result_state_count repeated_result_row_count resolution_status "
    "susceptibility source_file @ingested_at"
)


@query(ENDPOINT, "SELECT {columns} FROM endpoint", "endpoint")
def reconcile_endpoints(c: Context):
    return c.full.endpoints


@query(
    "l_partkey l_suppkey source_row_count distinct_result_state_count resolution_status l_returnflag",
    """SELECT l_partkey, l_suppkey, count(*) AS source_row_count, count(DISTINCT flag) + max((flag IS NULL)::int)
  AS distinct_result_state_count, CASE WHEN count(flag) = 0 THEN 'missing' WHEN count(flag) = count(*)
  AND min(flag) = max(flag) THEN 'resolved' ELSE 'conflict' END AS resolution_status,
  CASE WHEN count(flag) = count(*) AND min(flag) = max(flag) THEN min(flag) END AS l_returnflag
FROM (SELECT *, CASE WHEN l_quantity > 5 THEN l_returnflag END AS flag FROM lineitem) GROUP BY ALL""",
)
def reconcile_line_items(c: Context):
    """The same rule on a plain table with other column names and no lineage."""
    rows = c.table("lineitem").withColumn("l_returnflag", F.when(F.col("l_quantity") > 5, F.col("l_returnflag")))
    return reconcile.reconcile_endpoints(rows, ["l_partkey", "l_suppkey"], "l_returnflag", lineage=())


@query(
    "culture_organism_key antibiotic susceptibility source_row_count repeated_result_row_count susceptibility_key",
    """SELECT culture_organism_key, antibiotic, susceptibility, source_row_count, repeated_result_row_count,
  md5(culture_organism_key || '-' || antibiotic) AS susceptibility_key
FROM endpoint WHERE resolution_status = 'resolved'""",
    "endpoint",
)
def resolved_fact(c: Context):
    return c.full.resolved


@query(
    "culture_organism_key antibiotic resolution_status source_row_count",
    "SELECT {columns} FROM endpoint WHERE resolution_status IN ('missing', 'conflict')",
    "endpoint",
)
def exceptions(c: Context):
    return c.full.exceptions


GROUP_ENDPOINT = (
    "ast_scope reporting_source_key source_version cohort_id patient_key organism_reporting_group antibiotic "
    "source_endpoint_row_count source_organisms_with_endpoint source_conflict_count source_missing_count "
    "distinct_resolved_result_count #resolved_results #source_resolution_statuses resolution_status susceptibility "
    "reconciliation_reason"
)


@query(GROUP_ENDPOINT, "SELECT {columns} FROM group_endpoint", "group_endpoint")
def reconcile_group(c: Context):
    return c.full.group_endpoints


@query(GROUP_ENDPOINT, "SELECT {columns} FROM group_endpoint", "group_endpoint", window=True)
def reconcile_group_in_window(c: Context):
    return c.windowed.group_endpoints


@query(
    "ast_scope reporting_source_key antibiotic only_result",
    """SELECT ast_scope, reporting_source_key, antibiotic,
  CASE WHEN len(resolved_results) = 1 THEN resolved_results[1] END AS only_result FROM group_endpoint""",
    "group_endpoint",
)
def single_value(c: Context):
    return c.full.group_endpoints.withColumn("only_result", reconcile.single_value("resolved_results"))


# -- evidence --------------------------------------------------------------------------------------
@query(
    "organism_source cre_scope mdr_scope oxacillin_scope vre_scope esce_scope",
    "SELECT DISTINCT {columns} FROM scoped",
    "scoped",
)
def rule_scope(c: Context):
    labels = c.full.mapped.select("organism_source", "organism_standardized").distinct()
    return ev.with_rule_scopes(labels)


_PARTS = [(e.name, kind, part) for r in ref.RULES for e in r.evidence for kind, part in (
    ("positive", "pos"), ("negative", "neg"), ("non_evaluable", "unk"))]


@query(
    "culture_organism_key " + " ".join(f"{n}_{kind}_count" for n, kind, _ in _PARTS),
    "SELECT culture_organism_key, "
    + ", ".join(f"coalesce({n}_{part}, 0) AS {n}_{kind}_count" for n, kind, part in _PARTS)
    + " FROM scoped LEFT JOIN evidence_wide USING (culture_organism_key)",
    "scoped",
    "evidence_wide",
)
def evidence_counts(c: Context):
    records = c.full.mapped.select("culture_organism_key")
    return records.join(c.full.evidence, "culture_organism_key", "left").fillna(0)


@query(
    "culture_organism_key ast_cre_status ast_esce_enterobacterales_status ast_oxacillin_resistance_status "
    "ast_vancomycin_resistance_status",
    "SELECT {columns} FROM phenotype",
    "phenotype",
)
def marker_status(c: Context):
    return c.full.phenotypes


_CATEGORIES = " ".join(f"{e.name}_status" for e in ref.MDR.evidence)


@query(f"culture_organism_key {_CATEGORIES}", "SELECT {columns} FROM phenotype", "phenotype")
def category_status(c: Context):
    return c.full.phenotypes


@query(
    "culture_organism_key positives unknowns ast_mdr_p_aeruginosa_status",
    "SELECT {columns} FROM phenotype",
    "phenotype",
)
def k_of_n_status(c: Context):
    return c.full.phenotypes.withColumnsRenamed(
        {"mdr_positive_category_count": "positives", "mdr_unknown_category_count": "unknowns"}
    )


_FLAGS = " ".join(f"${r.flag}" for r in ref.RULES)


@query(
    f"{_FLAGS} records",
    "SELECT "
    + ", ".join(
        f"CASE {r.status} WHEN 'positive' THEN 'true' WHEN 'not_detected' THEN 'false' END AS {r.flag}" for r in ref.RULES
    )
    + ", count(*) AS records FROM phenotype GROUP BY ALL",
    "phenotype",
)
def tri_state_flags(c: Context):
    return profile.frequency(c.full.phenotypes, [r.flag for r in ref.RULES], "records")


@query(
    "culture_organism_key source_designated_cre source_designated_mrsa source_designated_vre",
    "SELECT {columns} FROM phenotype",
    "phenotype",
)
def source_designations(c: Context):
    return c.full.phenotypes


@query(
    "culture_organism_key reporting_phenotype organism_name", "SELECT {columns} FROM categorised", "categorised"
)
def priority_label(c: Context):
    return con.categorised_records(c.full.phenotypes)


# -- consolidation ---------------------------------------------------------------------------------
RECORD = (
    "reporting_culture_organism_key source_version patient_key cohort_id culture_key @culture_time_shifted "
    "$was_positive organism_reporting_group organism_name reporting_phenotype source_organism_record_count "
    "source_label_count standardized_identity_count #source_culture_organism_keys #source_labels "
    f"#standardized_identities #source_qualifiers {STATUS} source_designated_cre source_designated_mrsa "
    "source_designated_vre"
)


@query(RECORD, "SELECT {columns} FROM record", "record")
def consolidate(c: Context):
    return c.full.records


@query(
    "o_custkey merged flag",
    """SELECT o_custkey, merged, CASE merged WHEN 'positive' THEN 'true' WHEN 'not_detected' THEN 'false' END AS flag
FROM (SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'positive'
    WHEN bool_or(o_orderpriority = '1-URGENT') THEN 'not_evaluable' WHEN bool_or(o_totalprice > 300000)
    THEN 'not_detected' ELSE 'not_applicable' END AS merged FROM orders GROUP BY 1)""",
)
def status_precedence(c: Context):
    """Statuses given to orders, merged per customer."""
    status = (
        F.when(F.col("o_orderstatus") == "P", "positive")
        .when(F.col("o_orderpriority") == "1-URGENT", "not_evaluable")
        .when(F.col("o_totalprice") > 300000, "not_detected")
        .otherwise("not_applicable")
    )
    merged = c.table("orders").groupBy("o_custkey").agg(strongest_status(status).alias("merged"))
    return merged.withColumn("flag", tri_state("merged").cast("string"))


@query(
    "culture_key organism_reporting_group #members",
    """SELECT culture_key, organism_reporting_group,
  array_to_string(list_sort(list(DISTINCT member)), '|') AS members
FROM (SELECT culture_key, organism_reporting_group, unnest(source_labels) AS member FROM record) GROUP BY ALL""",
    "record",
)
def flatten_union(c: Context):
    return c.full.records.groupBy("culture_key", "organism_reporting_group").agg(
        con.flatten_union("source_labels", "members")
    )


OBSERVATION = (
    "reporting_culture_observation_key source_version cohort_id patient_key organism_reporting_group culture_key "
    "@culture_time_shifted #source_culture_organism_keys #source_reporting_phenotypes phenotype_records_on_culture "
    f"{STATUS}"
)


@query(OBSERVATION, "SELECT {columns} FROM observation", "observation")
def culture_observation(c: Context):
    return c.full.observations


@query(OBSERVATION, "SELECT {columns} FROM observation", "observation", window=True)
def culture_observation_in_window(c: Context):
    return c.windowed.observations


# -- selection -------------------------------------------------------------------------------------
@query(
    "reporting_source_key any_susceptible_marker any_other_marker",
    "SELECT reporting_source_key, any_s AS any_susceptible_marker, any_other AS any_other_marker FROM marker",
    "marker",
)
def marker_agreement(c: Context):
    return sel.marker_agreement(c.full.group_endpoints)


CANDIDATE = (
    "reporting_culture_organism_key source_version cohort_id patient_key organism_reporting_group "
    "reporting_phenotype organism_name culture_key @culture_time_shifted #source_culture_organism_keys " + STATUS
)


@query(CANDIDATE, "SELECT {columns} FROM candidate", "candidate")
def stratified_candidates(c: Context):
    return c.full.candidates


@query(
    "first_stratified_reporting_culture_key " + CANDIDATE, "SELECT {columns} FROM first_stratified", "first_stratified"
)
def first_per_category(c: Context):
    return c.full.first_stratified


@query(
    "first_stratified_reporting_culture_key " + CANDIDATE,
    "SELECT {columns} FROM first_stratified",
    "first_stratified",
    window=True,
)
def first_per_category_in_window(c: Context):
    return c.windowed.first_stratified


OVERALL = "overall_reporting_isolate_key organism_name " + OBSERVATION


@query(OVERALL, "SELECT {columns} FROM first_overall", "first_overall")
def first_overall(c: Context):
    return c.full.first_overall


@query(OVERALL, "SELECT {columns} FROM first_overall", "first_overall", window=True)
def first_overall_in_window(c: Context):
    return c.windowed.first_overall


@query(
    "user_id event_type event_id value",
    """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def first_event_per_type(c: Context):
    """First-record selection on the event table."""
    return sel.first_per_group(c.table("events"), ["user_id", "event_type"], ["ts", "event_id"])


SELECTED_ENDPOINT = (
    "antibiotic resolution_status susceptibility reconciliation_reason source_endpoint_row_count "
    "source_conflict_count source_missing_count distinct_resolved_result_count #resolved_results"
)


@query(
    "first_stratified_reporting_culture_key reporting_phenotype " + SELECTED_ENDPOINT,
    "SELECT {columns} FROM stratified_endpoint",
    "stratified_endpoint",
)
def attach_stratified_endpoints(c: Context):
    return c.full.first_stratified_endpoints


@query(
    "overall_reporting_isolate_key " + SELECTED_ENDPOINT, "SELECT {columns} FROM overall_endpoint", "overall_endpoint"
)
def attach_overall_endpoints(c: Context):
    return c.full.first_overall_endpoints


# -- the two tables --------------------------------------------------------------------------------
POPULATION = (
    "selected_reporting_isolate_key source_version cohort_id patient_key organism_reporting_group organism_name "
    "reporting_phenotype"
)
RESULT = "antibiotic resolution_status susceptibility reconciliation_reason"


@query(POPULATION, "SELECT {columns} FROM population", "population")
def union_populations(c: Context):
    return c.full.population


@query(
    f"selected_reporting_isolate_key reporting_phenotype {RESULT}",
    "SELECT {columns} FROM population_endpoint",
    "population_endpoint",
)
def union_endpoints(c: Context):
    return c.full.population_endpoints


@query(f"{POPULATION} antibiotic pair_order", "SELECT {columns} FROM approved", "approved")
def approved_grid(c: Context):
    return marts.approved_grid(c.full.population, c.seeds.pairs)


@query(f"{POPULATION} antibiotic pair_order", "SELECT {columns} FROM grid", "grid")
def wildcard_exclude(c: Context):
    return marts.wildcard_exclude(marts.approved_grid(c.full.population, c.seeds.pairs), c.seeds.exclusions)


def _attached(c: Context):
    grid = marts.wildcard_exclude(marts.approved_grid(c.full.population, c.seeds.pairs), c.seeds.exclusions)
    return marts.outer_attach(grid, c.full.population_endpoints)


@query(f"{POPULATION} pair_order {RESULT}", "SELECT {columns} FROM attached", "attached")
def outer_attach(c: Context):
    return _attached(c)


COUNTS = "eligible_count " + " ".join(marts.RESULT_COUNT_NAMES) + " untested_count"


@query(
    f"cohort_id antibiotic {COUNTS}",
    f"SELECT cohort_id, antibiotic, count(*) AS eligible_count, {RESULT_COUNTS}, "
    f"{any_rows('resolution_status IS NULL')} AS untested_count FROM attached GROUP BY ALL",
    "attached",
)
def endpoint_counts(c: Context):
    return marts.endpoint_counts(_attached(c), ["cohort_id", "antibiotic"])


@query(
    "o_custkey urgent_pct large_pct",
    f"""SELECT o_custkey, {pct("count(*) FILTER (WHERE o_orderpriority = '1-URGENT')", "count(*)")} AS urgent_pct,
  {pct("count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 250000)",
       "count(*) FILTER (WHERE o_orderpriority = '1-URGENT')")} AS large_pct
FROM orders GROUP BY 1""",
)
def guarded_percentages(c: Context):
    """Percentages, NULL where a customer has no urgent order."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    counted = c.table("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(urgent).alias("urgent"),
        F.count_if(urgent & (F.col("o_totalprice") > 250000)).alias("large"),
    )
    return counted.select(
        "o_custkey", safe_pct("urgent", "n").alias("urgent_pct"), safe_pct("large", "urgent").alias("large_pct")
    )


SUSCEPTIBILITY = (
    "susceptibility_mart_key source_version cohort_id organism_reporting_group organism_name reporting_phenotype "
    f"antibiotic pair_order {COUNTS} categorized_result_coverage_pct susceptible_pct resistant_pct display_status "
    "$analysis_window_start $analysis_window_end_exclusive gram_stain_group"
)
MDRO = (
    "mdro_mart_key source_version cohort_id organism_base_name mdro_phenotype denominator_count positive_count "
    "not_detected_count not_evaluable_count evaluable_count phenotype_pct evaluable_pct $analysis_window_start "
    "$analysis_window_end_exclusive gram_stain_group"
)


@query(SUSCEPTIBILITY, "SELECT {columns} FROM mart", "mart")
def susceptibility_mart(c: Context):
    return c.full.susceptibility


@query(SUSCEPTIBILITY, "SELECT {columns} FROM mart", "mart", window=True)
def susceptibility_mart_in_window(c: Context):
    return c.windowed.susceptibility


@query(SUSCEPTIBILITY, "SELECT {columns} FROM mart", "mart")
def susceptibility_mart_by_grid(c: Context):
    """The same table by way of the record × drug grid."""
    t = c.full
    return marts.grid_susceptibility_mart(
        t.population, t.population_endpoints, c.seeds.pairs, c.seeds.exclusions, c.seeds.groups, t.window
    )


@query(
    "cohort_id organism_name antibiotic categorized_count display_status",
    """SELECT cohort_id, organism_name, antibiotic, sum(categorized_count)::bigint AS categorized_count,
  CASE WHEN sum(categorized_count) >= 20 THEN 'display' ELSE 'insufficient_data' END AS display_status
FROM cell GROUP BY ALL""",
    "cell",
)
def display_threshold(c: Context):
    """Another threshold, over releases taken together."""
    from cohortgram.functions.measures import display_status

    merged = c.full.susceptibility.groupBy("cohort_id", "organism_name", "antibiotic").agg(
        F.sum("categorized_count").alias("categorized_count")
    )
    return merged.withColumn("display_status", display_status("categorized_count", 20))


@query(
    "organism_reporting_group gram_stain_group records",
    """SELECT organism_reporting_group, gram_stain_group, count(*) AS records
FROM record LEFT JOIN groups USING (organism_reporting_group) GROUP BY ALL""",
    "record",
    "groups",
)
def attach_attribute(c: Context):
    key = "organism_reporting_group"
    return profile.frequency(
        marts.attach_attribute(c.full.records, c.seeds.groups, key, key), [key, "gram_stain_group"], "records"
    )


@query(
    "source_version cohort_id patient_key organism_reporting_group mdro_phenotype phenotype_status",
    "SELECT {columns} FROM patient",
    "patient",
)
def patient_status(c: Context):
    return marts.patient_status(c.full.records, c.full.window)


@query(
    "mdro_phenotype denominator_count positive_count not_detected_count not_evaluable_count",
    f"""SELECT mdro_phenotype, count(*) AS denominator_count, {any_rows("phenotype_status = 'positive'")} AS
  positive_count, {any_rows("phenotype_status = 'not_detected'")} AS not_detected_count,
  {any_rows("phenotype_status = 'not_evaluable'")} AS not_evaluable_count FROM patient GROUP BY ALL""",
    "patient",
)
def status_summary(c: Context):
    return marts.status_summary(marts.patient_status(c.full.records, c.full.window), ["mdro_phenotype"])


@query(MDRO, "SELECT {columns} FROM mdro", "mdro")
def mdro_mart(c: Context):
    return c.full.mdro


@query(MDRO, "SELECT {columns} FROM mdro", "mdro", window=True)
def mdro_mart_in_window(c: Context):
    return c.windowed.mdro


# -- several windows at once -----------------------------------------------------------------------
STARTS = ("1997-01-01", "1997-07-01", "1998-01-01")
_STARTS = [date.fromisoformat(s) for s in STARTS]


@query(SUSCEPTIBILITY, "SELECT {columns} FROM mart", "mart", windows=STARTS)
def susceptibility_by_window(c: Context):
    return windows.susceptibility_by_window(c.full, _STARTS)


@query(MDRO, "SELECT {columns} FROM mdro", "mdro", windows=STARTS)
def mdro_by_window(c: Context):
    return windows.mdro_by_window(c.full, _STARTS)


_TREND_KEYS = ["source_version", "cohort_id", "organism_base_name", "mdro_phenotype"]


@query(
    f"{' '.join(_TREND_KEYS)} $analysis_window_start phenotype_pct previous_phenotype_pct phenotype_pct_change",
    "SELECT *, lag(phenotype_pct) OVER w AS previous_phenotype_pct, round(phenotype_pct - lag(phenotype_pct) OVER w, 1) "
    f"AS phenotype_pct_change FROM (SELECT {', '.join(_TREND_KEYS)}, year AS analysis_window_start, "
    "round(100.0 * count(*) FILTER (WHERE phenotype_status = 'positive') / count(*), 1)::double AS phenotype_pct FROM ("
    "SELECT source_version, cohort_id, patient_key, organism_reporting_group AS organism_base_name, mdro_phenotype, year, "
    "CASE max(CASE status WHEN 'positive' THEN 3 WHEN 'not_evaluable' THEN 2 WHEN 'not_detected' THEN 1 END) "
    "WHEN 3 THEN 'positive' WHEN 2 THEN 'not_evaluable' ELSE 'not_detected' END AS phenotype_status FROM ("
    "SELECT *, strftime(culture_time_shifted, '%Y-01-01') AS year, 'CRE' AS mdro_phenotype, ast_cre_status AS status "
    "FROM record UNION ALL SELECT *, strftime(culture_time_shifted, '%Y-01-01'), 'MDR Pseudomonas aeruginosa', "
    "ast_mdr_p_aeruginosa_status FROM record) WHERE status <> 'not_applicable' AND year IS NOT NULL "
    "GROUP BY ALL) GROUP BY ALL) "
    f"WINDOW w AS (PARTITION BY {', '.join(_TREND_KEYS)} ORDER BY analysis_window_start)",
    "record",
)
def mdro_trend(c: Context):
    """Yearly resistance percentages with the change from the year before."""
    return windows.change_between_windows(windows.mdro_by_window(c.full, 12), _TREND_KEYS, "phenotype_pct")
