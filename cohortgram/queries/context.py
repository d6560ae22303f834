"""What a query gets to work with: raw tables, and report relations built once per session."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgram.functions.windows import ReportWindow
from cohortgram.plans import quality
from cohortgram.plans.report import AUDIT_RELATIONS, ReportTables
from cohortgram.plans.storage import Scratch
from cohortgram.queries import source
from cohortgram.sources.seeds import Seeds
from cohortgram.sources.staging import stage_demographics, stage_ward

WINDOW = ReportWindow(date.fromisoformat(source.WINDOW_START))


class Context:
    """Relations with several readers are written once and read by all queries of the session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return source.table(self.spark, self.sf_dir, name)

    @cached_property
    def scratch(self) -> Scratch:
        return Scratch(self.spark)

    @cached_property
    def seeds(self) -> Seeds:
        return Seeds.built_in(self.spark)

    @cached_property
    def full(self) -> ReportTables:
        counts = quality.written_counts
        with self.scratch.splits_for(self.table("lineitem").count()):
            raw = self.scratch.keep("raw_cohort", source.raw_cohort(self.spark, self.sf_dir), counts=counts("raw_cohort"))
        return ReportTables(raw, self.seeds, scratch=self.scratch, keep=AUDIT_RELATIONS, counts=counts)

    @cached_property
    def windowed(self) -> ReportTables:
        return self.full.for_window(WINDOW)

    @cached_property
    def raw(self) -> DataFrame:
        return self.full.raw_cohort

    @cached_property
    def raw_ward(self) -> DataFrame:
        return source.raw_ward(self.spark, self.sf_dir)

    @cached_property
    def demographics(self) -> DataFrame:
        return stage_demographics(source.raw_demographics(self.spark, self.sf_dir))

    @cached_property
    def ward(self) -> DataFrame:
        return stage_ward(self.raw_ward)


_contexts: dict[tuple[str, str], Context] = {}


def context(spark: SparkSession, sf_dir: str) -> Context:
    """The session's context; relations already written for it are read, not built again."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _contexts:
        _contexts[key] = Context(spark, sf_dir)
    return _contexts[key]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Start over: the next query builds its relations again."""
    _contexts.pop((spark.sparkContext.applicationId, sf_dir), None)


def column_names(spec: str) -> list[str]:
    return [c.lstrip("@#$") for c in spec.split()]


def plain(frame: DataFrame, spec: str) -> DataFrame:
    """Select the columns of a spec: ``@`` times and ``#`` arrays become text, ``$`` is cast to text."""
    columns = []
    for item in spec.split():
        name = item.lstrip("@#$")
        if item[0] == "@":
            columns.append(F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name))
        elif item[0] == "#":
            columns.append(F.array_join(name, "|").alias(name))
        elif item[0] == "$":
            columns.append(F.col(name).cast("string").alias(name))
        else:
            columns.append(F.col(name))
    return frame.select(*columns)


def plain_sql(spec: str) -> str:
    """The same columns for the SQL side."""
    columns = []
    for item in spec.split():
        name = item.lstrip("@#$")
        if item[0] == "@":
            columns.append(f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {name}")
        elif item[0] == "#":
            columns.append(f"array_to_string({name}, '|') AS {name}")
        elif item[0] == "$":
            columns.append(f"cast({name} AS varchar) AS {name}")
        else:
            columns.append(name)
    return ", ".join(columns)
