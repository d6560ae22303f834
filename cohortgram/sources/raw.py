"""Raw CSV files: strict load, incremental append, count check, preview and file inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "inferSchema": False}
# A file whose header differs from the schema fails the read instead of shifting its columns.
CHECKED_HEADER = {"enforceSchema": False, "mode": "FAILFAST"}
_CORRUPT = "_corrupt_record"
_BOM = "^\ufeff"


def file_schema(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False) -> T.StructType:
    """The wanted columns in the order of the header Spark finds first; other columns of the file as text.

    Only that line is read. A header without a wanted column is an error.
    """
    found = spark.read.options(**CSV_OPTIONS, multiLine=multi_line).csv(path).columns
    wanted = {f.name.lower(): f for f in schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in {name.lower() for name in found}]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}: {', '.join(found)}")
    return T.StructType([T.StructField(n, wanted[n.lower()].dataType if n.lower() in wanted else T.StringType()) for n in found])


def load_raw(
    spark: SparkSession, path: str | list[str], schema: T.StructType, version: str, multi_line: bool = False
) -> DataFrame:
    """CSV as text columns plus file, release and load time; a malformed record fails the load.

    Columns are taken by header name. Files of one load share one header; a file with another fails, so
    load files of another layout apart. ``multi_line`` allows line breaks inside quotes and reads each file in one
    task; without it files split, and a record with such a break fails the load.
    """
    found = file_schema(spark, path, schema, multi_line)
    rows = spark.read.schema(found).options(**CSV_OPTIONS, **CHECKED_HEADER, multiLine=multi_line).csv(path)
    return rows.select(
        *schema.fieldNames(),
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(version).alias("source_version"),
        F.current_timestamp().alias("ingested_at"),
    )


def file_names(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """``source_file`` of every file below a path, from its listing; no file is opened."""
    listed = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(path)
    return listed.select(as_uri("path").alias("source_file"), F.col("path"))


def as_uri(path: str):
    """A column of paths, written alike: Spark writes local paths as file:/x in one place and file:///x in another."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def new_files(spark: SparkSession, path: str | list[str], loaded: DataFrame, pattern: str = "*.csv") -> list[str]:
    """The files below a path whose names ``loaded`` (``source_file``) lacks: one short name each."""
    names = loaded.select(as_uri("source_file").alias("source_file"))
    return [r.path for r in file_names(spark, path, pattern).join(names, "source_file", "left_anti").sort("path").collect()]


def append_new_files(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    version: str,
    loaded: DataFrame,
    multi_line: bool = False,
    pattern: str = "*.csv",
) -> DataFrame:
    """The rows of the files that ``loaded`` lacks. Other files are listed and never opened.

    ``loaded`` holds the names of loaded files: the ``source_file`` partitions or log of a table, not its rows, where
    it is large.
    """
    paths = new_files(spark, path, loaded, pattern)
    if paths:
        return load_raw(spark, paths, schema, version, multi_line)
    nothing = spark.createDataFrame([], schema)
    return nothing.select(
        "*",
        F.lit("").alias("source_file"),
        F.lit(version).alias("source_version"),
        F.current_timestamp().alias("ingested_at"),
    )


def row_count_check(tables: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Actual against expected row counts (``table_name, expected_rows``), one row per table."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("actual_rows")).select(F.lit(name).alias("table_name"), "actual_rows")
        for name, frame in tables.items()
    ]
    difference = F.col("actual_rows") - F.col("expected_rows")
    return (
        reduce(DataFrame.unionByName, counts)
        .join(expected.select("table_name", F.col("expected_rows").cast("long")), "table_name", "left")
        .select(
            "*",
            difference.alias("difference"),
            F.when(difference == 0, "PASS").otherwise("CHECK").alias("row_count_check"),
        )
    )


def preview(table: DataFrame, rows: int = 100, order: list[str] | None = None) -> DataFrame:
    """The first rows of a table, in key order if one is given (a top-n, not a full sort)."""
    return (table.orderBy(*order) if order else table).limit(rows)


def line_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Per file: size, lines, a fingerprint of its lines, and the first line.

    The fingerprint adds up a hash per line, so tasks sum their own split of a file; it tells whether two files
    hold the same lines.
    """
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size_bytes"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value"
            ).alias("at"),
        )
    )
    # ``min`` over a struct keeps one line per map task before the shuffle.
    return lines.groupBy("path", "size_bytes").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.xxhash64("at.value").cast("decimal(20,0)")).cast("string").alias("line_fingerprint"),
        F.min("at").alias("first"),
    ).withColumn("first", F.regexp_replace("first.value", _BOM + "|\r$", ""))


def header_columns(line):
    """The fields of a header line; commas inside quotes do not part them."""
    fields = F.regexp_extract_all(line, F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    bare = lambda f: F.when(f.startswith('"'), F.regexp_replace(F.regexp_replace(f, '^"|"$', ""), '""', '"')).otherwise(f)
    return F.transform(fields, lambda f: F.trim(bare(F.trim(f))))


def record_inventory(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*", multi_line: bool = False
) -> DataFrame:
    """Per file: data rows, records with the wrong number of fields, and records with no value at all.

    ``multi_line`` as in the load, so that both see the same records.
    """
    names = schema.fieldNames()
    read_schema = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(read_schema)
        .options(**CSV_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, enforceSchema=True, multiLine=multi_line)
        .option("pathGlobFilter", pattern)
        .csv(path)
    )
    empty = reduce(lambda a, b: a & b, [F.col(n).isNull() for n in names])
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("data_row_count"),
        F.count_if(F.col(_CORRUPT).isNotNull()).alias("field_count_error_count"),
        F.count_if(empty).alias("empty_record_count"),
    )


def source_inventory(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*", multi_line: bool = False
) -> DataFrame:
    """Size, fingerprint, header and record structure of every file under ``path``."""
    lines = line_inventory(spark, path, pattern).withColumn("columns", header_columns(F.col("first"))).drop("first")
    named = F.filter("columns", lambda name: name != "")
    headers = lines.select(
        "*",
        F.size("columns").alias("column_count"),
        F.array_sort(
            F.filter(F.array_distinct(named), lambda n: F.size(F.filter(named, lambda other: other == n)) > 1)
        ).alias("duplicate_column_names"),
        F.filter(
            F.transform("columns", lambda name, i: F.when(name == "", i + 1)), lambda position: position.isNotNull()
        ).alias("blank_column_positions"),
    )
    records = record_inventory(spark, path, schema, pattern, multi_line)
    return headers.withColumn("path", as_uri("path")).join(records.withColumn("path", as_uri("path")), "path", "left")
