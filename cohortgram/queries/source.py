"""Laboratory-shaped raw tables derived from the star-schema test tables.

A customer stands for a patient, the orders of one customer in one quarter for a culture, a line item for
one result row. Every line item of every order becomes a row. Labels, drugs and results come from columns
of the rows, so repeated rows, conflicts, sentinels and unmapped labels all occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Labels in the order a customer and year pick them.
LABELS = (
    "ESCHERICHIA COLI",
    "ESCHERICHIA COLI (CARBAPENEM RESISTANT)",
    "STAPHYLOCOCCUS AUREUS",
    "STAPH AUREUS {MRSA}",
    "KLEBSIELLA PNEUMONIAE",
    "KLEBSIELLA OXYTOCA",
    "PSEUDOMONAS AERUGINOSA",
    "MUCOID PSEUDOMONAS AERUGINOSA",
    "ENTEROCOCCUS FAECALIS",
    "ENTEROCOCCUS FAECALIS - VANCO RESISTANT",
    "ENTEROCOCCUS FAECIUM",
    "ENTEROBACTER CLOACAE COMPLEX",
    "ZZZENTEROBACTER AEROGENES",
    "PROTEUS MIRABILIS",
    "MORGANELLA MORGANII",
    "PROTEUS VULGARIS",
    "STREPTOCOCCUS PNEUMONIAE",
    "CANDIDA ALBICANS",
    "SERRATIA MARCESCENS",
    "CITROBACTER KOSERI",
)
# Panel per label position, and nine drugs per panel.
PANEL_OF_LABEL = "EESSEEPPNNNEEEEEGGEE"
PANEL_DRUGS = {
    "E": (
        "Ceftriaxone",
        "Ertapenem",
        "Meropenem",
        "Ciprofloxacin",
        "Gentamicin",
        "Piperacillin/Tazobactam",
        "Ampicillin",
        "Trimethoprim/Sulfamethoxazole",
        "Imipenem",
    ),
    "S": (
        "Oxacillin",
        "Cefoxitin",
        "Vancomycin",
        "Clindamycin",
        "Erythromycin",
        "Linezolid",
        "Trimethoprim/Sulfamethoxazole",
        "Oxacillin",
        "Cefoxitin",
    ),
    "P": (
        "Cefepime",
        "Ciprofloxacin",
        "Tobramycin",
        "Meropenem",
        "Piperacillin/Tazobactam",
        "Cefiderocol",
        "Amikacin",
        "Gentamicin",
        "Imipenem",
    ),
    "N": (
        "Ampicillin",
        "Vancomycin",
        "Penicillin",
        "Linezolid",
        "Daptomycin",
        "Vancomycin",
        "Ampicillin",
        "Nitrofurantoin",
        "Penicillin",
    ),
    "G": (
        "Penicillin",
        "Ceftriaxone",
        "Erythromycin",
        "Trimethoprim/Sulfamethoxazole",
        "Levofloxacin",
        "Moxifloxacin",
        "Vancomycin",
        "Clindamycin",
        "vancomycin",
    ),
}
DRUGS_PER_PANEL = 9
# Result texts.
RESULTS = ("Susceptible", "Resistant", "Intermediate", "Inconclusive", "Synergism", "Null", " Null ")
# Culture description per market segment.
DESCRIPTIONS = {
    "BUILDING": "BLOOD",
    "MACHINERY": "URINE",
    "AUTOMOBILE": "RESPIRATORY",
    "HOUSEHOLD": "URINE",
    "FURNITURE": "WOUND",
}
RELEASES = {"F": "2025-04-11", "P": "2025-04-11", "O": "2025-10-01"}
ORDERING_MODES = {"1-URGENT": "Inpatient", "2-HIGH": " Null ", "4-NOT SPECIFIED": "Null"}
WINDOW_START = "1998-01-01"
#: Lines of a task that joins them with their orders.
PART_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(t) for pair in values.items() for t in pair]), key)


def _release() -> Column:
    return _lookup(RELEASES, F.col("o_orderstatus"))


def _order_ids() -> list[Column]:
    quarter = F.concat(F.year("o_orderdate"), F.lit("Q"), F.quarter("o_orderdate"))
    return [
        F.concat(F.lit("P"), F.col("o_custkey")).alias("anon_id"),
        F.concat(F.lit("V"), F.col("o_custkey"), F.lit("-"), F.year("o_orderdate")).alias("pat_enc_csn_id_coded"),
        F.concat(F.lit("C"), F.col("o_custkey"), F.lit("-"), quarter).alias("order_proc_id_coded"),
    ]


def _order_time() -> Column:
    hour = (F.col("o_orderkey") % 24).cast("int")
    text = F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hour), "yyyy-MM-dd HH:mm:ss")
    return F.when(F.col("o_orderkey") % 97 == 0, "time unknown").otherwise(text)


def _ingest() -> list[Column]:
    return [
        F.concat(F.lit("cultures_"), F.year("o_orderdate"), F.lit(".csv")).alias("source_file"),
        _release().alias("source_version"),
        F.concat(_release(), F.lit(" 06:00:00")).cast("timestamp").alias("ingested_at"),
    ]


def raw_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per line item.

    What is read of a line or an order is worked out before they are joined, and orders meet their customers first: lines are shuffled once and
    narrow, and texts of an order are made once, not by each of its lines.
    """
    neighbour = F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "R"), 1).otherwise(0)
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    result = (
        F.when((flag == "R") & (quantity <= 25), RESULTS.index("Resistant"))
        .when((flag == "N") & (quantity <= 3), RESULTS.index("Null"))
        .when((flag == "N") & (quantity <= 5), RESULTS.index(" Null "))
        .when((flag == "N") & (quantity <= 8), RESULTS.index("Inconclusive"))
        .when((flag == "N") & (quantity <= 10), RESULTS.index("Synergism"))
        .when((flag == "N") & (quantity <= 25), RESULTS.index("Intermediate"))
        .otherwise(RESULTS.index("Susceptible"))
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (F.col("l_suppkey") % DRUGS_PER_PANEL).cast("int").alias("_drug"),
        (F.col("l_tax") >= 0.08).alias("_untested"),
        neighbour.alias("_neighbour"),
        result.alias("_result"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    negative = F.col("o_orderpriority") == "5-LOW"
    description = _lookup(DESCRIPTIONS, F.col("c_mktsegment"))
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        (F.col("o_custkey") * 3 + F.year("o_orderdate") % 2).alias("_first"),
        negative.alias("_negative"),
        *_order_ids(),
        _order_time().alias("order_time_jittered_utc"),
        F.coalesce(_lookup(ORDERING_MODES, F.col("o_orderpriority")), F.lit("Outpatient")).alias("ordering_mode"),
        F.when(F.col("c_nationkey") == 0, F.lower(description))
        .when(F.col("c_nationkey") == 1, F.concat(F.lit(" "), description))
        .otherwise(description)
        .alias("culture_description"),
        F.when(negative, "0").when(F.col("o_orderkey") % 89 == 0, "1.0").otherwise("1").alias("was_positive"),
        *_ingest(),
    )
    parts = -(-lines.count() // PART_ROWS)
    # However many shuffle partitions there are, adaptive execution may merge them down to one per core.
    if parts > min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism):
        lines, orders = lines.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    pick = ((F.col("_first") + F.col("_neighbour")) % len(LABELS)).cast("int")
    panels = F.array(*[F.array(*[F.lit(d) for d in PANEL_DRUGS[p]]) for p in PANEL_OF_LABEL])
    negative, untested = F.col("_negative"), F.col("_untested")
    result = F.get(F.array(*[F.lit(text) for text in RESULTS]), F.col("_result"))
    picked = rows.withColumn("_pick", pick)
    return picked.select(
        "anon_id",
        "pat_enc_csn_id_coded",
        "order_proc_id_coded",
        "order_time_jittered_utc",
        "ordering_mode",
        "culture_description",
        "was_positive",
        F.when(negative, "Null")
        .otherwise(F.get(F.array(*[F.lit(label) for label in LABELS]), F.col("_pick")))
        .alias("organism"),
        F.when(negative | untested, "Null")
        .otherwise(F.get(F.get(panels, F.col("_pick")), F.col("_drug")))
        .alias("antibiotic"),
        F.when(negative | untested, "Null").otherwise(result).alias("susceptibility"),
        "source_file",
        "source_version",
        "ingested_at",
    )


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per patient, encounter and culture order of a release."""
    band = F.floor(F.col("c_acctbal") / 2000).cast("int")
    age = F.when(band < 0, " Null ").when(band >= 4, "above 90").otherwise(
        F.concat((band * 20).cast("string"), F.lit("-"), (band * 20 + 19).cast("string"), F.lit(" years"))
    )
    gender = F.when(F.col("c_nationkey") % 5 == 4, "Null").otherwise((F.col("c_nationkey") % 2).cast("string"))
    return _raw_orders(spark, sf_dir).select(
        *_order_ids(),
        age.alias("age"),
        gender.alias("gender"),
        F.lit("demographics.csv").alias("source_file"),
        *_ingest()[1:],
    ).distinct()


def raw_ward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per order, with overlapping care-setting flags."""
    priority, price = F.col("o_orderpriority"), F.col("o_totalprice")
    flags = {
        "hosp_ward_IP": priority.isin("1-URGENT", "2-HIGH"),
        "hosp_ward_OP": priority.isin("3-MEDIUM", "5-LOW"),
        "hosp_ward_ER": price > 250000,
        "hosp_ward_ICU": (price > 400000) & (priority == "1-URGENT"),
    }
    return _raw_orders(spark, sf_dir).select(
        *_order_ids(),
        _order_time().alias("order_time_jittered_utc"),
        *[F.when(flag, "1").otherwise("0").alias(name) for name, flag in flags.items()],
        F.lit("ward.csv").alias("source_file"),
        *_ingest()[1:],
    )
