"""Source exploration and grain validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortgram import reference as ref
from cohortgram.functions.schemas import ORDER_KEYS
from cohortgram.operators import audits, heavy, profile
from cohortgram.plans import Scratch, quality
from cohortgram.plans.report import ORDER_ATTRIBUTES
from cohortgram.queries.context import Context
from cohortgram.queries.registry import query
from cohortgram.queries.sql import any_rows

KEYS = ", ".join(ORDER_KEYS)
RESULT_KEYS = [*ORDER_KEYS, "organism", "antibiotic"]
TEXT_COLUMNS = ["ordering_mode", "culture_description", "was_positive", "organism", "antibiotic", "susceptibility"]


@query(
    "order_proc_id_coded row_count",
    """SELECT order_proc_id_coded, count(*) AS row_count FROM raw GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 10""",
    "raw",
)
def largest_keys(c: Context):
    return profile.largest_keys(c.raw, ["order_proc_id_coded"])


def _heavy(c: Context, keys: list[str]):
    return heavy.heavy_keys(c.raw, keys, 10, Scratch(c.spark))


@query(
    "organism antibiotic row_count",
    """SELECT organism, antibiotic, count(*) AS row_count FROM raw GROUP BY ALL
ORDER BY 3 DESC, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 10""",
    "raw",
)
def heavy_organism_drugs(c: Context):
    return _heavy(c, ["organism", "antibiotic"])


@query(
    "anon_id row_count",
    """SELECT anon_id, count(*) AS row_count FROM raw GROUP BY 1
ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10""",
    "raw",
)
def heavy_patients(c: Context):
    return _heavy(c, ["anon_id"])


@query(
    "row_count key_count",
    "SELECT source_row_count AS row_count, count(*) AS key_count FROM culture GROUP BY 1",
    "culture",
)
def rows_per_key_histogram(c: Context):
    return profile.rows_per_key_histogram(c.full.staged, ORDER_KEYS)


@query(
    "column_name value row_count",
    " UNION ALL ".join(
        f"SELECT '{col}' AS column_name, {col} AS value, count(*) AS row_count FROM raw GROUP BY 2" for col in TEXT_COLUMNS
    ),
    "raw",
)
def value_inventory(c: Context):
    return profile.value_inventory(c.raw, TEXT_COLUMNS)


@query(
    "column_name row_count null_count sentinel_count",
    " UNION ALL ".join(
        f"SELECT '{col}' AS column_name, count(*) AS row_count, count(*) - count({col}) AS null_count, "
        f"{any_rows(col + chr(32) + '= ' + chr(39) + 'Null' + chr(39))} AS sentinel_count FROM staged"
        for col in ("ordering_mode", "organism", "antibiotic", "susceptibility", "susceptibility_raw")
    ),
    "staged",
)
def column_profile(c: Context):
    return profile.column_profile(
        c.full.staged, ["ordering_mode", "organism", "antibiotic", "susceptibility", "susceptibility_raw"]
    )


_REPEATS = """SELECT sum(n)::bigint AS rows, count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1)
  AS keys_with_repeats, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::bigint AS rows_sharing_a_key,
  sum(n - 1)::bigint AS surplus_rows FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})"""


@query(
    "rows distinct_keys keys_with_repeats rows_sharing_a_key surplus_rows",
    _REPEATS.replace("{source}", "raw").replace("{keys}", "ALL").replace("SELECT count(*) AS n FROM raw GROUP BY ALL",
    "SELECT anon_id, pat_enc_csn_id_coded, order_proc_id_coded, order_time_jittered_utc, ordering_mode, "
    "culture_description, was_positive, organism, antibiotic, susceptibility, source_file, source_version, ingested_at, "
    "count(*) AS n FROM raw GROUP BY ALL"),
    "raw",
)
def exact_duplicates(c: Context):
    return profile.duplicate_profile(c.raw)


@query(
    "rows distinct_keys keys_with_repeats rows_sharing_a_key surplus_rows",
    _REPEATS.replace("{source}", "staged").replace("{keys}", "patient_key, culture_order_key, organism, antibiotic"),
    "staged",
)
def duplicates_on_key(c: Context):
    return profile.duplicate_profile(c.full.staged, ["patient_key", "culture_order_key", "organism", "antibiotic"])


@query(
    "column_name distinct_values rows",
    " UNION ALL ".join(
        f"SELECT '{col}' AS column_name, count(DISTINCT {col}) AS distinct_values, count(*) AS rows FROM demographics"
        for col in ("patient_key", "encounter_key", "culture_order_key", "age", "gender")
    ),
    "demographics",
)
def key_cardinality(c: Context):
    return profile.key_cardinality(
        c.demographics, ["patient_key", "encounter_key", "culture_order_key", "age", "gender"]
    )


@query(
    "match key_count left_rows right_rows cardinality",
    f"""SELECT match, count(*) AS key_count, coalesce(sum(l), 0)::bigint AS left_rows,
  coalesce(sum(r), 0)::bigint AS right_rows,
  CASE WHEN max(l) > 1 THEN 'm' ELSE '1' END || ':' || CASE WHEN max(r) > 1 THEN 'm' ELSE '1' END AS cardinality
FROM (SELECT l, r, CASE WHEN r IS NULL THEN 'left_only' WHEN l IS NULL THEN 'right_only' ELSE 'both' END AS match
  FROM (SELECT {KEYS}, count(*) AS l FROM staged GROUP BY ALL)
  FULL JOIN (SELECT {KEYS}, count(*) AS r FROM ward GROUP BY ALL) USING ({KEYS})) GROUP BY match""",
    "staged",
    "ward",
)
def join_key_audit(c: Context):
    return profile.join_key_audit(c.full.staged, c.ward, ORDER_KEYS)


@query(
    "rows_before rows_after unmatched_rows",
    f"""SELECT (SELECT count(*) FROM staged) AS rows_before,
  (SELECT count(*) FROM staged LEFT JOIN demographics d USING ({KEYS})) AS rows_after,
  (SELECT count(*) FROM staged ANTI JOIN demographics d USING ({KEYS})) AS unmatched_rows""",
    "staged",
    "demographics",
)
def join_row_check(c: Context):
    return profile.join_row_check(c.full.staged, c.demographics, ORDER_KEYS)


FLAGS = ["hosp_ward_ip", "hosp_ward_op", "hosp_ward_er", "hosp_ward_icu"]


@query(
    "flags_set row_count",
    "SELECT hosp_ward_ip + hosp_ward_op + hosp_ward_er + hosp_ward_icu AS flags_set, count(*) AS row_count FROM ward GROUP BY 1",
    "ward",
)
def flag_histogram(c: Context):
    return profile.flag_histogram(c.ward, FLAGS)


@query(
    " ".join(FLAGS) + " row_count",
    f"SELECT {', '.join(FLAGS)}, count(*) AS row_count FROM ward GROUP BY ALL",
    "ward",
)
def flag_combinations(c: Context):
    return profile.flag_combinations(c.ward, FLAGS)


_CONFLICTS = f"""SELECT {KEYS}, organism, antibiotic, count(*) AS row_count,
    count(DISTINCT coalesce(susceptibility, '<missing>')) AS state_count,
    array_to_string(list_sort(list(DISTINCT coalesce(susceptibility, '<missing>'))), ' + ') AS pattern
  FROM staged GROUP BY {KEYS}, organism, antibiotic
  HAVING count(DISTINCT coalesce(susceptibility, '<missing>')) > 1"""


def _conflicts(c: Context):
    return profile.conflict_groups(c.full.staged, RESULT_KEYS, "susceptibility")


@query(
    "culture_order_key organism antibiotic row_count state_count pattern",
    f"SELECT {{columns}} FROM ({_CONFLICTS})",
    "staged",
)
def conflict_groups(c: Context):
    return _conflicts(c)


@query(
    "pattern group_count row_count",
    f"SELECT pattern, count(*) AS group_count, sum(row_count)::bigint AS row_count FROM ({_CONFLICTS}) GROUP BY 1",
    "staged",
)
def conflict_patterns(c: Context):
    return profile.conflict_patterns(_conflicts(c))


@query(
    "conflict_groups conflict_rows orders patients",
    f"""SELECT count(*) AS conflict_groups, sum(row_count)::bigint AS conflict_rows,
  count(DISTINCT concat_ws('|', {KEYS})) AS orders, count(DISTINCT patient_key) AS patients FROM ({_CONFLICTS})""",
    "staged",
)
def conflict_reach(c: Context):
    return profile.conflict_reach(_conflicts(c), ["source_version", "encounter_key", "culture_order_key"], "patient_key")


@query(
    "column_name key_count inconsistent_keys",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_name, count(*) AS key_count, count(*) FILTER (WHERE n > 1) AS inconsistent_keys FROM "
        f"(SELECT count(DISTINCT coalesce(cast({a} AS varchar), '?')) AS n FROM staged GROUP BY {KEYS})"
        for a in ORDER_ATTRIBUTES
    ),
    "staged",
)
def attribute_consistency(c: Context):
    return profile.attribute_consistency(c.full.staged, ORDER_KEYS, ORDER_ATTRIBUTES)


@query(
    "rows missing_text unparsed_text",
    f"""SELECT count(*) AS rows, {any_rows('order_time_jittered_utc_raw IS NULL')} AS missing_text,
  {any_rows('order_time_jittered_utc_raw IS NOT NULL AND culture_time_shifted IS NULL')} AS unparsed_text FROM ward""",
    "ward",
)
def parse_failures(c: Context):
    return profile.parse_failures(c.ward, "order_time_jittered_utc_raw", "culture_time_shifted")


@query(
    "agreement pair_count",
    f"""SELECT agreement, count(*) AS pair_count FROM (
  SELECT CASE WHEN a AND b THEN 'agree' WHEN a THEN 'left_only' ELSE 'right_only' END AS agreement FROM (
    SELECT {KEYS}, culture_time_shifted, bool_or(side = 'a') AS a, bool_or(side = 'b') AS b FROM (
      SELECT {KEYS}, culture_time_shifted, 'a' AS side FROM culture
      UNION ALL SELECT {KEYS}, culture_time_shifted, 'b' FROM ward) GROUP BY ALL)) GROUP BY 1""",
    "culture",
    "ward",
)
def time_agreement(c: Context):
    return profile.time_agreement(c.full.cultures, c.ward, ORDER_KEYS, "culture_time_shifted")


@query(
    "culture_description was_positive row_count",
    """SELECT CASE WHEN grouping(d) = 1 THEN 'All' ELSE d END AS culture_description,
  CASE WHEN grouping(p) = 1 THEN 'All' ELSE p END AS was_positive, count(*) AS row_count
FROM (SELECT coalesce(culture_description, '<missing>') AS d, coalesce(cast(was_positive AS varchar), '<missing>') AS p
  FROM culture) GROUP BY CUBE (d, p)""",
    "culture",
)
def crosstab(c: Context):
    return profile.crosstab(c.full.cultures, "culture_description", "was_positive")


@query(
    "rows distinct_keys conflicts",
    "SELECT count(*) AS rows, count(DISTINCT culture_key) AS distinct_keys, "
    f"{any_rows('has_order_level_conflict')} AS conflicts FROM culture",
    "culture",
)
def grain_check(c: Context):
    return profile.grain_check(c.full.cultures, "culture_key", {"conflicts": F.col("has_order_level_conflict")})


@query(
    "rows distinct_keys repeated",
    "SELECT count(*) AS rows, count(DISTINCT culture_key) AS distinct_keys, "
    f"{any_rows('has_repeated_antibiotic_records')} AS repeated FROM culture_organism",
    "culture_organism",
)
def culture_organism_grain(c: Context):
    return profile.grain_check(
        c.full.culture_organisms, "culture_key", {"repeated": F.col("has_repeated_antibiotic_records")}
    )


@query(
    "model_name row_count",
    """SELECT 'raw_cohort' AS model_name, count(*) AS row_count FROM raw
UNION ALL SELECT 'staged', count(*) FROM staged UNION ALL SELECT 'culture', count(*) FROM culture""",
    "raw",
    "staged",
    "culture",
)
def layer_counts(c: Context):
    """Two layers are counted while they are written, one by a scan."""
    layers = {"raw_cohort": c.raw, "staged": c.full.staged, "culture": c.full.cultures}
    written = {"raw_cohort": c.scratch.counted.get("raw_cohort", {}), "culture": c.full.counted.get("cultures", {})}
    return quality.layer_counts(layers, written)


@query(
    "model_name row_count",
    """SELECT 'raw_cohort' AS model_name, count(*) AS row_count FROM raw
UNION ALL SELECT 'staged', count(*) FROM staged UNION ALL SELECT 'culture', count(*) FROM culture""",
    "raw",
    "staged",
    "culture",
)
def layer_counts_by_scan(c: Context):
    return profile.layer_counts({"raw_cohort": c.raw, "staged": c.full.staged, "culture": c.full.cultures})


# -- labels ----------------------------------------------------------------------------------------
@query("organism culture_count", "SELECT organism, count(*) AS culture_count FROM culture_organism GROUP BY 1", "culture_organism")
def label_frequency(c: Context):
    return profile.frequency(c.full.culture_organisms, ["organism"], "culture_count")


@query(
    "cohort_id organism culture_organism_rows patients",
    """SELECT cohort_id, organism, count(*) AS culture_organism_rows, count(DISTINCT patient_key) AS patients
FROM cohort_record GROUP BY ALL""",
    "cohort_record",
)
def label_frequency_by_cohort(c: Context):
    return profile.frequency(c.full.cohort_records, ["cohort_id", "organism"], "culture_organism_rows", "patient_key")


@query(
    "organism record_count",
    """SELECT organism, count(*) AS record_count FROM cohort_record WHERE organism LIKE '%SPECIES%' OR
organism LIKE '%GROUP%' OR organism LIKE '%COMPLEX%' OR organism LIKE '%MUCOID%' OR organism LIKE '%CF%' GROUP BY 1""",
    "cohort_record",
)
def labels_for_review(c: Context):
    return audits.labels_matching(
        c.full.cohort_records, "organism", ["SPECIES", "GROUP", "COMPLEX", "MUCOID", "CF"]
    )


# -- reconciliation --------------------------------------------------------------------------------
@query(
    "resolution_status susceptibility_groups source_rows",
    """SELECT resolution_status, count(*) AS susceptibility_groups, sum(source_row_count)::bigint AS source_rows
FROM endpoint GROUP BY 1""",
    "endpoint",
)
def reconciliation_outcomes(c: Context):
    return c.full.endpoints.groupBy("resolution_status").agg(
        F.count(F.lit(1)).alias("susceptibility_groups"), F.sum("source_row_count").alias("source_rows")
    )


@query(
    "susceptibility result_count",
    "SELECT susceptibility, count(*) AS result_count FROM endpoint WHERE resolution_status = 'resolved' GROUP BY 1",
    "endpoint",
)
def result_categories(c: Context):
    return profile.frequency(c.full.resolved, ["susceptibility"], "result_count")


_WORST = (
    "resolution_status organism antibiotic distinct_result_state_count distinct_nonnull_category_count "
    "missing_susceptibility_row_count repeated_result_row_count source_row_count culture_organism_key"
)


@query(
    _WORST,
    """SELECT {columns} FROM endpoint WHERE resolution_status <> 'resolved'
ORDER BY distinct_result_state_count DESC, source_row_count DESC, culture_organism_key, antibiotic LIMIT 50""",
    "endpoint",
)
def worst_conflicts(c: Context):
    order = [F.desc("distinct_result_state_count"), F.desc("source_row_count"), "culture_organism_key", "antibiotic"]
    return profile.top(c.full.exceptions, order, 50)


@query(
    "organism antibiotic conflicting_groups",
    """SELECT organism, antibiotic, count(*) AS conflicting_groups FROM endpoint
WHERE resolution_status = 'conflict' GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 50""",
    "endpoint",
)
def conflicts_by_pair(c: Context):
    pairs = profile.frequency(
        c.full.exceptions.filter("resolution_status = 'conflict'"), ["organism", "antibiotic"], "conflicting_groups"
    )
    return profile.top(pairs, [F.desc("conflicting_groups"), "organism", "antibiotic"], 50)


@query(
    "culture_organism_key antibiotic row_count",
    "SELECT culture_organism_key, antibiotic, count(*) AS row_count FROM endpoint GROUP BY ALL HAVING count(*) > 1",
    "endpoint",
)
def duplicate_endpoints(c: Context):
    from cohortgram.operators.rollup import repeated_rows

    return repeated_rows(c.full.endpoints, ["culture_organism_key", "antibiotic"])


# -- cohorts ---------------------------------------------------------------------------------------
@query(
    "cohort_id culture_organism_rows culture_orders patients source_organism_labels",
    """SELECT cohort_id, count(*) AS culture_organism_rows, count(DISTINCT culture_key) AS culture_orders,
  count(DISTINCT patient_key) AS patients, count(DISTINCT organism) AS source_organism_labels
FROM cohort_record GROUP BY 1""",
    "cohort_record",
)
def cohort_sizes(c: Context):
    return audits.cohort_sizes(c.full.cohort_records)


@query(
    "culture_description culture_orders",
    """SELECT culture_description, count(*) AS culture_orders FROM culture
WHERE culture_description NOT IN ('BLOOD', 'URINE', 'RESPIRATORY') GROUP BY 1""",
    "culture",
)
def unassigned_descriptions(c: Context):
    return audits.unassigned_descriptions(c.full.cultures, list(ref.COHORT_OF_DESCRIPTION))


@query(
    "cohort_id culture_organism_rows positive_rows",
    f"""SELECT cohort_id, count(*) AS culture_organism_rows, {any_rows('was_positive = 1')} AS positive_rows
FROM cohort_record GROUP BY 1""",
    "cohort_record",
)
def positive_records(c: Context):
    return c.full.cohort_records.groupBy("cohort_id").agg(
        F.count(F.lit(1)).alias("culture_organism_rows"),
        F.count_if(F.coalesce(F.col("was_positive") == 1, F.lit(False))).alias("positive_rows"),
    )
