"""The two tables for many reporting windows at once, and their change from window to window.

The windows a record counts in are an interval, so tables come from running sums over window starts (``operators.sweep``). The form that
copies a record to every window that holds it is kept for record-level listings, and for tests that hold both equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortgram.functions.measures import n_rows, tally
from cohortgram.functions.statuses import status_rank
from cohortgram.functions.windows import WINDOW_MONTHS, ReportWindow
from cohortgram.operators import consolidate, marts, reconcile, select, sweep
from cohortgram.operators.sweep import WINDOW_KEYS, WindowGrid
from cohortgram.plans.report import ReportTables
from cohortgram.reference import MDRO_LABELS

Starts = Sequence[date] | int


def in_windows(records: DataFrame, starts: Starts, time: str = "culture_time_shifted") -> DataFrame:
    """Records with each window they fall in; a record is copied as often as windows overlap on it.

    ``starts`` are dates, or a number of months: then a window starts on the first day of every so many months, counted
    from the year 0. A record finds its own windows, so the plan does not grow with their number and no range is asked of
    the data.
    """
    usable = records.filter(F.col(time).isNotNull())
    if isinstance(starts, int):
        month = F.year(time) * 12 + F.month(time) - 1
        last = F.floor(month / starts).cast("int")
        first = F.floor((month - WINDOW_MONTHS) / starts).cast("int") + 1
        index = F.filter(F.sequence(F.least(first, last), last), lambda i: i >= first)
        own = F.transform(index, lambda i: F.make_date(F.floor(i * starts / 12).cast("int"), i * starts % 12 + 1, F.lit(1)))
    else:
        given = F.lit(sorted(set(starts))).cast("array<date>")
        own = F.filter(given, lambda s: (F.col(time) >= s) & (F.col(time) < F.add_months(s, WINDOW_MONTHS)))
    windows = usable.select("*", F.explode(own).alias(WINDOW_KEYS[0]))
    return windows.withColumn(WINDOW_KEYS[1], F.add_months(WINDOW_KEYS[0], WINDOW_MONTHS))


def susceptibility_by_window(tables: ReportTables, starts: Starts) -> DataFrame:
    """The susceptibility table of every window; patients are selected anew in each.

    Which windows a record is selected in is an interval, and its results are reconciled once.
    """
    whole, grid, seeds = ReportWindow(), WindowGrid.of(starts), tables.seeds
    records, time, culture = tables.records, "culture_time_shifted", "culture_key"
    stratified = sweep.first_in_windows(
        select.stratified_candidates(records, whole), select.CATEGORY_KEYS, [time, culture, select.RECORD_KEY], grid
    )
    observations = consolidate.culture_observations(
        records.filter(F.col("organism_reporting_group").isin(*select.OVERALL_GROUPS)), whole
    )
    overall = sweep.first_in_windows(observations, select.PATIENT_GROUP, [time, culture], grid).withColumns(
        {"organism_name": F.col("organism_reporting_group"), "reporting_phenotype": F.lit("overall")}
    )
    columns = (*sweep.SPAN, *marts.CELL, culture, consolidate.MEMBERS)
    selected = stratified.select(F.col(select.RECORD_KEY).alias(marts.POPULATION), *columns).unionByName(
        overall.select(F.col("reporting_culture_observation_key").alias(marts.POPULATION), *columns)
    )
    if tables.scratch is not None:
        # Read for the denominators and for the endpoints.
        selected = tables.scratch.keep_by(f"selected-{uuid.uuid4().hex}", selected, culture)

    dimensions = (*WINDOW_KEYS, *marts.CELL)
    cells = sweep.counts_by_window(selected, marts.CELL, [n_rows().alias("eligible_count")], ["eligible_count"], grid)
    drugs = marts.active_pairs(seeds.pairs).select("antibiotic").distinct()
    results = reconcile.reconcile_group(
        selected,
        tables.endpoints.join(drugs, "antibiotic", "left_semi"),
        (marts.POPULATION, *sweep.SPAN, *marts.CELL),
        result_sets=False,
        parent=reconcile.shared_parent(selected, tables.endpoints),
    )
    counted = sweep.counts_by_window(
        results, (*marts.CELL, "antibiotic"), marts.result_counts(), marts.RESULT_COUNT_NAMES, grid
    )
    panel = marts.panel_cells(cells, seeds.pairs, seeds.exclusions)
    return marts.measured_panel(panel, counted, dimensions, seeds.groups, None, tables.minimum)


def mdro_by_window(tables: ReportTables, starts: Starts) -> DataFrame:
    """The resistance table of every window.

    A patient's status in a window is the strongest of the cultures in it. Per strength, the patients with that status or
    a stronger one are counted by the first such culture of a window; neighbouring counts differ by the patients of one status.
    """
    grid = WindowGrid.of(starts)
    time = "culture_time_shifted"
    observed = marts.applicable_status(tables.records, MDRO_LABELS, [*select.PATIENT_GROUP, time])
    levels = observed.select(
        *select.PATIENT_GROUP, time, "mdro_phenotype", F.explode(F.sequence(status_rank("status"), F.lit(4))).alias("level")
    ).withColumnRenamed("organism_reporting_group", "organism_base_name")
    patient = ("source_version", "cohort_id", "patient_key", "organism_base_name", "mdro_phenotype", "level")
    first = sweep.first_in_windows(levels, patient, [time], grid)
    at_least = [tally(F.col("level") == i).alias(f"_{i}") for i in (4, 1, 2, 3)]
    held = sweep.counts_by_window(first, marts.MDRO_KEYS, at_least, ["_4", "_1", "_2", "_3"], grid)
    summary = held.select(
        *WINDOW_KEYS,
        *marts.MDRO_KEYS,
        F.col("_4").alias("denominator_count"),
        F.col("_1").alias("positive_count"),
        (F.col("_3") - F.col("_2")).alias("not_detected_count"),
        (F.col("_2") - F.col("_1")).alias("not_evaluable_count"),
    )
    return marts.finish_mdro(summary, tables.seeds.groups, None)


def copied_susceptibility_by_window(tables: ReportTables, starts: Starts) -> DataFrame:
    """``susceptibility_by_window`` by way of a copy of each record per window, for checks and record-level listings."""
    whole = ReportWindow()
    records = in_windows(tables.records, starts)
    candidates = select.stratified_candidates(records, whole, WINDOW_KEYS)
    observations = consolidate.culture_observations(
        records.filter(F.col("organism_reporting_group").isin(*select.OVERALL_GROUPS)), whole, extra_keys=WINDOW_KEYS
    )
    selected = marts.selected_members(
        select.first_overall(observations, extra_keys=WINDOW_KEYS),
        select.first_per_category(candidates, extra_keys=WINDOW_KEYS),
        WINDOW_KEYS,
    )
    seeds = tables.seeds
    return marts.susceptibility_mart(
        selected, tables.endpoints, seeds.pairs, seeds.exclusions, seeds.groups, whole, tables.minimum, carry=WINDOW_KEYS
    )


def copied_mdro_by_window(tables: ReportTables, starts: Starts) -> DataFrame:
    """``mdro_by_window`` by way of the same copies."""
    records = in_windows(tables.records, starts)
    return marts.mdro_mart(records, tables.seeds.groups, ReportWindow(), extra_keys=WINDOW_KEYS)


def change_between_windows(mart: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """A measure beside its value in the window before, per row of the report."""
    order = Window.partitionBy(*keys).orderBy("analysis_window_start")
    previous = F.lag(measure).over(order)
    return mart.select(
        "*",
        previous.alias(f"previous_{measure}"),
        F.round(F.col(measure) - previous, 1).alias(f"{measure}_change"),
    )
