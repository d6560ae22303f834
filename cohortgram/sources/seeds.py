"""Reference tables as DataFrames.

The built-in tables are created from Arrow, which Spark keeps as a local relation with an exact size, and
CSV tables carry their file size. Joins below never hint a broadcast: Spark broadcasts a table whose known
size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles a larger one.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortgram import reference as ref
from cohortgram.sources.raw import CHECKED_HEADER, CSV_OPTIONS, file_schema

_INTEGER_COLUMNS = {"include_primary_summary", "include_primary_dashboard", "pair_order", "category_order"}
SEED_COLUMNS = {
    "organism_mapping": ref.LABEL_COLUMNS,
    "organism_reporting_groups": ref.GROUP_COLUMNS,
    "reportable_organism_antibiotic_pairs": ref.PAIR_COLUMNS,
    "organism_antibiotic_exclusions": ref.EXCLUSION_COLUMNS,
}


def seed_schema(name: str) -> str:
    return ", ".join(f"{c} {'int' if c in _INTEGER_COLUMNS else 'string'}" for c in SEED_COLUMNS[name])


def small_table(spark: SparkSession, columns: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """Literal rows as a DataFrame whose size Spark knows."""
    fields = [pa.field(c, pa.int32() if c in _INTEGER_COLUMNS else pa.string()) for c in columns]
    data = list(zip(*rows)) if rows else [()] * len(columns)
    arrays = [pa.array(list(values), type=f.type) for values, f in zip(data, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=pa.schema(fields)))


def load_seed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A typed reference table from CSV, its columns taken by header name."""
    wanted = T.StructType.fromDDL(seed_schema(name))
    found = file_schema(spark, path, wanted)
    rows = spark.read.schema(found).options(**CSV_OPTIONS, **CHECKED_HEADER).csv(path)
    return rows.select(*wanted.fieldNames())


@dataclass(frozen=True)
class Seeds:
    """The four reference tables a report needs."""

    labels: DataFrame
    groups: DataFrame
    pairs: DataFrame
    exclusions: DataFrame

    @classmethod
    def built_in(cls, spark: SparkSession) -> Seeds:
        return cls(
            labels=small_table(spark, ref.LABEL_COLUMNS, ref.label_rows()),
            groups=small_table(spark, ref.GROUP_COLUMNS, ref.group_rows()),
            pairs=small_table(spark, ref.PAIR_COLUMNS, ref.pair_rows()),
            exclusions=small_table(spark, ref.EXCLUSION_COLUMNS, ref.exclusion_rows()),
        )

    @classmethod
    def from_csv(cls, spark: SparkSession, directory: str) -> Seeds:
        return cls(*(load_seed(spark, name, f"{directory}/{name}.csv") for name in SEED_COLUMNS))
