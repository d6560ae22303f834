"""Loading, staging, keys and roll-ups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.cleaning import safe_cast, sentinel_to_null
from cohortgram.functions.keys import surrogate_key
from cohortgram.functions.schemas import COHORT_SCHEMA, ORDER_KEYS
from cohortgram.operators import profile, rollup, vocabulary
from cohortgram.queries.context import WINDOW, Context
from cohortgram.queries.registry import query
from cohortgram.queries.sql import CRE_GROUP, key
from cohortgram.sources import export, raw, seeds
from cohortgram.sources.ledger import LoadLedger
from cohortgram.streaming import load_new_files

RAW_TEXT = " ".join(COHORT_SCHEMA.fieldNames())


def _land(c: Context, path: str, release: str | None = None) -> str:
    """Raw rows as CSV files, those of one release or all, added to a landing folder.

    Files hold the columns in the opposite order of the schema.
    """
    rows = c.raw if release is None else c.raw.filter(F.col("source_version") == release)
    text = rows.select(*reversed(COHORT_SCHEMA.fieldNames()))
    text.write.mode("append").options(header=True, quoteAll=True, **export.EXACT_TEXT).csv(path)
    return path


def _folder(c: Context, name: str) -> str:
    return c.scratch.folder(f"{name}-{uuid.uuid4().hex}")


RELEASES = ("2025-04-11", "2025-10-01")
#: Rows of one landed file at most, so that no task writes or takes in more.
ROWS_PER_FILE = 4_000_000


def _land_half(rows: DataFrame, path: str, count: int, rows_per_file: int) -> int:
    """Lands rows, of known number, as even files of a bounded size, and returns how many."""
    files = max(1, -(-count // rows_per_file))
    rows.repartition(files).write.mode("append").options(header=True, quoteAll=True, **export.EXACT_TEXT).csv(path)
    return files


# -- loading ---------------------------------------------------------------------------------------
@query(RAW_TEXT + " source_version", "SELECT {columns} FROM raw", "raw")
def load_raw(c: Context):
    """Each release landed in a folder of its own and loaded under its version."""
    loaded = [raw.load_raw(c.spark, _land(c, _folder(c, "landing"), r), COHORT_SCHEMA, r) for r in RELEASES]
    return loaded[0].unionByName(loaded[1])


@query(
    "source_version organism row_count",
    """SELECT CASE source_version WHEN '2025-04-11' THEN 'first' ELSE 'second' END AS source_version, organism,
  count(*) AS row_count FROM raw GROUP BY ALL""",
    "raw",
)
def append_new_files(c: Context):
    """One release is loaded; a later load sees both releases and reads only the files that are new."""
    paths = [_land(c, _folder(c, "landing"), r) for r in RELEASES]
    table = raw.load_raw(c.spark, paths[0], COHORT_SCHEMA, "first")
    loaded = raw.file_names(c.spark, paths[0])
    new = raw.append_new_files(c.spark, paths, COHORT_SCHEMA, "second", loaded)
    return profile.frequency(table.unionByName(new), ["source_version", "organism"])


@query(
    "organism row_count",
    "SELECT organism, count(*) AS row_count FROM raw GROUP BY organism",
    "raw",
)
def incremental_load(c: Context):
    """The streamed load, run after each landing and once more: every file is loaded once."""
    landing, table, progress = (_folder(c, n) for n in ("landing", "loaded", "progress"))
    for release in (*RELEASES, None):
        if release is not None:
            _land(c, landing, release)
        load_new_files(c.spark, landing, COHORT_SCHEMA, "r", table, progress).awaitTermination()
    return profile.frequency(c.spark.read.parquet(table), ["organism"])


@query(
    "source_version organism row_count files",
    """SELECT source_version, organism, count(*) AS row_count, 2 AS files FROM (
  SELECT organism, source_version FROM raw) GROUP BY ALL""",
    "raw",
)
def ledger_load(c: Context):
    """Loads with a ledger after each landing, and once more: every file counts once; a load that never commits does not count."""
    landing = [_folder(c, "landing") for _ in RELEASES]
    ledger = LoadLedger(c.spark, _folder(c, "ledger"), COHORT_SCHEMA)
    half_of = F.pmod(F.xxhash64(*COHORT_SCHEMA.fieldNames()), F.lit(2))
    halves = c.raw.groupBy("source_version", half_of.alias("half")).agg(F.count(F.lit(1)).alias("n"))
    sizes = {(r.source_version, r.half): r.n for r in halves.filter(F.col("source_version").isin(*RELEASES)).collect()}
    more_files = 0
    for release, path in zip(RELEASES, landing):
        for part in range(2):
            half = c.raw.filter((F.col("source_version") == release) & (half_of == part))
            rows = sizes.get((release, part), 0)
            more_files += _land_half(half.select(*COHORT_SCHEMA.fieldNames()), path, rows, ROWS_PER_FILE) - 1
        ledger.stage([tuple(r) for r in ledger.new_files(path).collect()], "never")
        ledger.load(path, release, files_per_load=1)
    ledger.load(landing, "again")
    # Two files of each release are in the ledger, besides the further ones of large halves, so files loaded twice would show in both columns.
    files = ledger.files().agg(((F.count("*") - F.lit(more_files)) / F.lit(len(RELEASES))).cast("int").alias("files"))
    return profile.frequency(ledger.rows(), ["source_version", "organism"]).crossJoin(F.broadcast(files))


@query(
    "table_name actual_rows expected_rows difference row_count_check",
    """SELECT 'raw_cohort' AS table_name, n AS actual_rows, l AS expected_rows, n - l AS difference,
  'PASS' AS row_count_check FROM (SELECT count(*) AS n FROM raw), (SELECT count(*) AS l FROM lineitem)
UNION ALL SELECT 'raw_ward', n, l, n - l, 'CHECK' FROM (SELECT count(*) AS n FROM raw_ward),
  (SELECT count(*) AS l FROM lineitem)""",
    "raw",
    "raw_ward",
)
def row_count_check(c: Context):
    """The line items are what the cohort table must hold; the ward table, held against them too, does not."""
    lines = c.table("lineitem").agg(F.count("*").alias("expected_rows"))
    expected = lines.select(F.explode(F.array(F.lit("raw_cohort"), F.lit("raw_ward"))).alias("table_name"), "expected_rows")
    return raw.row_count_check({"raw_cohort": c.raw, "raw_ward": c.raw_ward}, expected)


@query(
    RAW_TEXT,
    "SELECT {columns} FROM raw ORDER BY " + ", ".join(RAW_TEXT.split()) + " LIMIT 100",
    "raw",
)
def preview(c: Context):
    return raw.preview(c.raw, 100, RAW_TEXT.split())


@query(
    "organism_source organism_reporting_group source_qualifier mapping_status label_rows",
    """SELECT organism AS organism_source, organism_reporting_group, source_qualifier,
  coalesce(mapping_status, 'unmapped') AS mapping_status, count(*) AS label_rows
FROM staged LEFT JOIN labels ON organism = organism_source WHERE organism IS NOT NULL GROUP BY ALL""",
    "staged",
    "labels",
)
def load_seed(c: Context):
    """The label map written as CSV, columns in another order, loaded with its schema, and put on the staged rows."""
    path = _folder(c, "seed")
    export.write_csv(c.seeds.labels.select(*reversed(c.seeds.labels.columns)), path)
    labels = seeds.load_seed(c.spark, "organism_mapping", path)
    rows = c.full.staged.filter("organism is not null").select(F.col("organism").alias("organism_source"))
    return profile.frequency(
        vocabulary.map_labels(rows, labels),
        ["organism_source", "organism_reporting_group", "source_qualifier", "mapping_status"],
        "label_rows",
    )


@query(
    "organism antibiotic row_count",
    "SELECT organism, antibiotic, cast(count(*) AS varchar) AS row_count FROM raw GROUP BY ALL",
    "raw",
)
def write_csv(c: Context):
    """A coverage table written as CSV and read back as text."""
    path = _folder(c, "coverage")
    export.write_csv(profile.frequency(c.raw, ["organism", "antibiotic"]), path)
    return c.spark.read.csv(path, schema="organism string, antibiotic string, row_count string", header=True, escape='"')


@query(
    "column_count data_row_count data_line_count field_count_error_count empty_record_count blank_names",
    """SELECT 10 AS column_count, count(*) AS data_row_count,
  count(*) + count(*) FILTER (WHERE was_positive = '1.0' AND ordering_mode <> 'Null') AS data_line_count,
  0::bigint AS field_count_error_count, count(*) FILTER (WHERE ordering_mode = 'Null') AS empty_record_count,
  0::bigint AS blank_names FROM raw
UNION ALL SELECT 9, count(*), count(*), count(*), 0, 0 FROM raw""",
    "raw",
)
def source_inventory(c: Context):
    """Files with line breaks in quotes and empty records, and files that lack a column."""
    names = COHORT_SCHEMA.fieldNames()
    broken = F.concat("organism", F.lit("\nsecond line"))
    text = {n: F.col(n) for n in names} | {
        "organism": F.when(F.col("was_positive") == "1.0", broken).otherwise(F.col("organism"))
    }
    emptied = [F.when(F.col("ordering_mode") != "Null", column).alias(n) for n, column in text.items()]
    paths = [_folder(c, "inventory") for _ in range(2)]
    export.write_csv(c.raw.select(*emptied), paths[0])
    export.write_csv(c.raw.select(*names[:-1]), paths[1])
    files = raw.source_inventory(c.spark, paths, COHORT_SCHEMA, "*.csv", multi_line=True)
    return files.groupBy("column_count").agg(
        F.sum("data_row_count").alias("data_row_count"),
        # Less the header line of each file.
        F.sum(F.col("line_count") - 1).alias("data_line_count"),
        F.sum("field_count_error_count").alias("field_count_error_count"),
        F.sum("empty_record_count").alias("empty_record_count"),
        F.sum(F.size("blank_column_positions")).cast("long").alias("blank_names"),
    )


# -- cleaning and staging --------------------------------------------------------------------------
@query(
    "raw_value cleaned_value row_count",
    """SELECT ordering_mode AS raw_value, nullif(trim(ordering_mode), 'Null') AS cleaned_value, count(*) AS row_count
FROM raw GROUP BY ALL""",
    "raw",
)
def sentinel_to_null_trimmed(c: Context):
    rows = c.raw.select(
        F.col("ordering_mode").alias("raw_value"), sentinel_to_null("ordering_mode").alias("cleaned_value")
    )
    return profile.frequency(rows, ["raw_value", "cleaned_value"])


@query(
    "raw_value cleaned_value row_count",
    """SELECT susceptibility AS raw_value, CASE WHEN susceptibility <> 'Null' THEN trim(susceptibility) END
  AS cleaned_value, count(*) AS row_count FROM raw GROUP BY ALL""",
    "raw",
)
def sentinel_to_null_raw(c: Context):
    cleaned = sentinel_to_null("susceptibility", compare="raw").alias("cleaned_value")
    rows = c.raw.select(F.col("susceptibility").alias("raw_value"), cleaned)
    return profile.frequency(rows, ["raw_value", "cleaned_value"])


@query(
    "was_positive $typed parsed_time row_count",
    """SELECT was_positive, CASE was_positive WHEN '0' THEN '0' WHEN '1' THEN '1' END AS typed,
  try_cast(order_time_jittered_utc AS timestamp) IS NOT NULL AS parsed_time, count(*) AS row_count
FROM raw GROUP BY ALL""",
    "raw",
)
def safe_casts(c: Context):
    rows = c.raw.select(
        "was_positive",
        safe_cast("was_positive", "int").alias("typed"),
        safe_cast("order_time_jittered_utc", "timestamp").isNotNull().alias("parsed_time"),
    )
    return profile.frequency(rows, ["was_positive", "typed", "parsed_time"])


@query(
    "patient_key encounter_key culture_order_key order_time_jittered_utc_raw @culture_time_shifted ordering_mode "
    "culture_description $was_positive organism antibiotic susceptibility_raw susceptibility source_file "
    "source_version @ingested_at",
    "SELECT {columns} FROM staged",
    "staged",
)
def stage_cohort(c: Context):
    return c.full.staged


@query(
    "patient_key encounter_key culture_order_key age_raw gender_raw age gender source_version",
    "SELECT {columns} FROM demographics",
    "demographics",
)
def stage_demographics(c: Context):
    return c.demographics


@query(
    "patient_key encounter_key culture_order_key order_time_jittered_utc_raw @culture_time_shifted hosp_ward_ip "
    "hosp_ward_op hosp_ward_er hosp_ward_icu source_version",
    "SELECT {columns} FROM ward",
    "ward",
)
def stage_ward(c: Context):
    return c.ward


@query(
    "reporting_culture_organism_key @culture_time_shifted $analysis_window_start $analysis_window_end_exclusive",
    """SELECT reporting_culture_organism_key, strftime(culture_time_shifted, '%Y-%m-%d %H:%M:%S') AS
  culture_time_shifted, {window_start} AS analysis_window_start, {window_end} AS analysis_window_end_exclusive
FROM windowed""",
    "windowed",
    window=True,
)
def report_window_filter(c: Context):
    rows = c.full.records.filter(WINDOW.usable("culture_time_shifted"))
    return rows.select("reporting_culture_organism_key", "culture_time_shifted", *WINDOW.columns())


@query(
    "cohort_id culture_description culture_orders",
    """SELECT lower(culture_description) AS cohort_id, culture_description, count(*) AS culture_orders FROM culture
WHERE culture_description IN ('BLOOD', 'URINE', 'RESPIRATORY') GROUP BY ALL""",
    "culture",
)
def assign_cohort(c: Context):
    return profile.frequency(
        vocabulary.assign_cohort(c.full.cultures), ["cohort_id", "culture_description"], "culture_orders"
    )


@query(
    "organism_reporting_group records",
    """SELECT organism_reporting_group, count(*) AS records FROM mapped WHERE include_primary_summary = 1
  AND mapping_status = 'reviewed' AND organism_reporting_group IS NOT NULL GROUP BY 1""",
    "mapped",
)
def reporting_eligible(c: Context):
    return profile.frequency(
        vocabulary.reporting_eligible(c.full.mapped), ["organism_reporting_group"], "records"
    )


# -- keys and roll-ups -----------------------------------------------------------------------------
@query(
    "culture_key order_count",
    f"SELECT {key('o_custkey', 'o_orderstatus', 'p')} AS culture_key, count(*) AS order_count "
    "FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS p FROM orders) GROUP BY 1",
)
def surrogate_keys(c: Context):
    """Keys over a natural key with a NULL part."""
    orders = c.table("orders").withColumn("p", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return profile.frequency(
        orders.withColumn("culture_key", surrogate_key("o_custkey", "o_orderstatus", "p")), ["culture_key"], "order_count"
    )


CULTURE = (
    "culture_key source_version patient_key encounter_key culture_order_key @culture_time_shifted ordering_mode "
    "culture_description $was_positive has_order_level_conflict source_row_count source_file @ingested_at"
)


@query(CULTURE, "SELECT {columns} FROM culture", "culture")
def consistent_rollup(c: Context):
    return c.full.cultures


@query(
    "o_custkey $o_orderstatus $o_orderpriority has_order_level_conflict source_row_count",
    """SELECT o_custkey, CASE WHEN s = 1 THEN a END AS o_orderstatus, CASE WHEN p = 1 THEN b END AS o_orderpriority,
  s > 1 OR p > 1 AS has_order_level_conflict, n AS source_row_count
FROM (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus) AS s, min(o_orderstatus) AS a,
    count(DISTINCT coalesce(nullif(o_orderpriority, '5-LOW'), '?')) AS p, min(nullif(o_orderpriority, '5-LOW')) AS b
  FROM orders GROUP BY 1)""",
)
def consistent_rollup_orders(c: Context):
    """The roll-up with other names, no lineage, and NULL as a state."""
    orders = c.table("orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return rollup.consistent_rollup(
        orders, ["o_custkey"], ["o_orderstatus", "o_orderpriority"], "customer_key", lineage=()
    )


CULTURE_ORGANISM = (
    "culture_organism_key culture_key source_version patient_key encounter_key culture_order_key organism "
    "source_row_count antibiotic_result_row_count distinct_antibiotic_count has_repeated_antibiotic_records "
    "source_file @ingested_at"
)


@query(CULTURE_ORGANISM, "SELECT {columns} FROM culture_organism", "culture_organism")
def child_rollup(c: Context):
    return c.full.culture_organisms


@query(
    "orphans",
    "SELECT count(*) AS orphans FROM culture_organism co ANTI JOIN culture c USING (culture_key)",
    "culture_organism",
    "culture",
)
def children_without_parent(c: Context):
    missing = rollup.without_parent(c.full.culture_organisms, c.full.cultures, ORDER_KEYS)
    return missing.agg(F.count(F.lit(1)).alias("orphans"))


@query("organism", "SELECT DISTINCT organism FROM culture_organism", "culture_organism")
def vocabulary_of_labels(c: Context):
    return vocabulary.vocabulary(c.full.culture_organisms, "organism")


@query(
    "organism_source_key organism_source organism_standardized organism_reporting_group source_qualifier "
    "include_primary_summary mapping_status has_reviewed_mapping",
    "SELECT {columns} FROM dimension",
    "dimension",
)
def map_vocabulary(c: Context):
    return c.full.organisms


MAPPED = (
    "culture_organism_key culture_key source_version patient_key cohort_id @culture_time_shifted culture_description "
    "$was_positive organism_source organism_source_key organism_standardized organism_reporting_group "
    "source_qualifier include_primary_summary mapping_status has_reviewed_mapping"
)


@query(MAPPED, "SELECT {columns} FROM mapped", "mapped")
def enrich_with_dimension(c: Context):
    return vocabulary.enrich_with_dimension(c.full.cohort_records, c.full.organisms)


@query(MAPPED, "SELECT {columns} FROM mapped", "mapped")
def map_labels(c: Context):
    return c.full.mapped


@query(
    "culture_organism_key cohort_id organism @culture_time_shifted culture_description $was_positive",
    "SELECT {columns} FROM cohort_record",
    "cohort_record",
)
def attach_culture_context(c: Context):
    return c.full.cohort_records


# -- output ----------------------------------------------------------------------------------------
@query(
    "susceptibility_mart_key eligible_count categorized_count $analysis_window_start report_window",
    """SELECT susceptibility_mart_key, eligible_count, categorized_count, {window_start} AS analysis_window_start,
  '1998-01-01' AS report_window FROM mart""",
    "mart",
    window=True,
)
def export_mart(c: Context):
    """Two windows exported side by side; the second export leaves the first in place."""
    path = _folder(c, "export")
    export.export_mart(c.windowed.susceptibility, path)
    export.export_mart(c.full.susceptibility, path)
    written = c.spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(path)
    return written.filter(F.col("analysis_window_start").isNotNull()).withColumn(
        "report_window", F.col("report_window").cast("string")
    )


@query(
    "cre_group organism_source label_rows",
    f"""SELECT {CRE_GROUP} AS cre_group, organism AS organism_source, count(*) AS label_rows
FROM (SELECT *, organism AS organism_source FROM staged WHERE organism IS NOT NULL)
GROUP BY ALL HAVING cre_group IS NOT NULL""",
    "staged",
)
def label_patterns(c: Context):
    from cohortgram.operators.audits import CRE_LABEL_GROUPS, label_group

    rows = c.full.staged.select(
        F.col("organism").alias("organism_source"), label_group("organism", CRE_LABEL_GROUPS).alias("cre_group")
    )
    return profile.frequency(rows.filter("cre_group is not null"), ["cre_group", "organism_source"], "label_rows")
