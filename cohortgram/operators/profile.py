"""Profiles of a table: keys, values, duplicates, joins, conflicts and grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgram.functions.measures import n_rows, safe_pct, tally
from cohortgram.operators.rollup import repeated_summary



def unpivot_values(rows: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(column_name, value) per cell, in one scan."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return rows.select(*keep, F.inline(cells))


# -- keys ------------------------------------------------------------------------------------------
def rows_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(n_rows().alias("row_count"))


def largest_keys(rows: DataFrame, keys: Sequence[str], top: int = 10) -> DataFrame:
    return rows_per_key(rows, keys).orderBy(F.desc("row_count"), *keys).limit(top)


def rows_per_key_histogram(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows_per_key(rows, keys).groupBy("row_count").agg(n_rows().alias("key_count"))


def key_cardinality(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column; each (column, value) is combined before it is counted."""
    values = unpivot_values(rows, columns).groupBy("column_name", "value").agg(n_rows().alias("n"))
    return values.groupBy("column_name").agg(
        F.count("value").alias("distinct_values"), F.sum("n").alias("rows")
    )


def duplicate_profile(rows: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Repeats on the given keys, or exact duplicates when no key is given."""
    return repeated_summary(rows, keys or rows.columns)


# -- values ----------------------------------------------------------------------------------------
def value_inventory(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return unpivot_values(rows, columns).groupBy("column_name", "value").agg(n_rows().alias("row_count"))


def column_profile(rows: DataFrame, columns: Sequence[str], sentinel: str = "Null") -> DataFrame:
    """NULL and sentinel counts of every column, from one aggregate over the table."""
    counted = rows.agg(
        n_rows().alias("rows"),
        *[tally(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        *[tally(F.col(c).cast("string") == sentinel).alias(f"sentinel_{c}") for c in columns],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("rows").alias("row_count"),
                F.col(f"null_{c}").alias("null_count"),
                F.col(f"sentinel_{c}").alias("sentinel_count"),
            )
            for c in columns
        ]
    )
    return counted.select(F.inline(cells))


def crosstab(rows: DataFrame, by: str, across: str, margin: str = "All") -> DataFrame:
    """Counts of each pair of values with row, column and grand totals."""

    def label(column: str) -> Column:
        text = F.coalesce(F.col(column).cast("string"), F.lit("<missing>"))
        return F.when(F.grouping(column) == 1, margin).otherwise(text).alias(column)

    return rows.cube(by, across).agg(
        n_rows().alias("row_count"), label(by).alias(f"_{by}"), label(across).alias(f"_{across}")
    ).select(F.col(f"_{by}").alias(by), F.col(f"_{across}").alias(across), "row_count")


def flag_histogram(rows: DataFrame, flags: Sequence[str]) -> DataFrame:
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f), F.lit(0)) for f in flags])
    return rows.groupBy(total.alias("flags_set")).agg(n_rows().alias("row_count"))


def flag_combinations(rows: DataFrame, flags: Sequence[str]) -> DataFrame:
    return rows.groupBy(*flags).agg(n_rows().alias("row_count"))


# -- joins -----------------------------------------------------------------------------------------
def join_key_audit(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on both sides or one, and whether the join would be 1:1, 1:m, m:1 or m:m.

    Both sides are counted per key before they meet, so repeats on both never multiply.
    """
    marked = (
        left.groupBy(*keys)
        .agg(n_rows().alias("left_rows"))
        .join(right.groupBy(*keys).agg(n_rows().alias("right_rows")), list(keys), "full")
    )
    side = (
        F.when(F.col("right_rows").isNull(), "left_only").when(F.col("left_rows").isNull(), "right_only").otherwise("both")
    )
    many_left, many_right = F.max("left_rows") > 1, F.max("right_rows") > 1
    cardinality = F.concat(
        F.when(many_left, "m").otherwise("1"), F.lit(":"), F.when(many_right, "m").otherwise("1")
    )
    return marked.groupBy(side.alias("match")).agg(
        n_rows().alias("key_count"),
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("right_rows"),
        cardinality.alias("cardinality"),
    )


def join_row_check(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left table before and after a left join, from key counts alone."""
    counts = left.groupBy(*keys).agg(n_rows().alias("n")).join(
        right.groupBy(*keys).agg(n_rows().alias("m")), list(keys), "left"
    )
    return counts.agg(
        F.sum("n").alias("rows_before"),
        F.sum(F.col("n") * F.coalesce("m", F.lit(1))).alias("rows_after"),
        F.coalesce(F.sum(F.when(F.col("m").isNull(), F.col("n"))), F.lit(0)).alias("unmatched_rows"),
    )


# -- conflicts -------------------------------------------------------------------------------------
MISSING_TEXT = "<missing>"


def conflict_groups(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with more than one state of a category column (NULL is a state) and the pattern of their states.

    The states of a key are combined first, so a pattern is made of distinct categories, not of rows.
    """
    states = rows.groupBy(*keys, F.coalesce(F.col(value), F.lit(MISSING_TEXT)).alias("_state")).agg(n_rows().alias("_n"))
    grouped = states.groupBy(*keys).agg(
        F.sum("_n").alias("row_count"),
        n_rows().alias("state_count"),
        F.concat_ws(" + ", F.array_sort(F.collect_set("_state"))).alias("pattern"),
    )
    return grouped.filter("state_count > 1")


def conflict_patterns(groups: DataFrame) -> DataFrame:
    return groups.groupBy("pattern").agg(n_rows().alias("group_count"), F.sum("row_count").alias("row_count"))


def conflict_reach(groups: DataFrame, order_keys: Sequence[str], patient: str) -> DataFrame:
    """Groups, rows, orders and patients touched by conflicts."""
    orders = groups.groupBy(*order_keys, patient).agg(n_rows().alias("g"), F.sum("row_count").alias("r"))
    patients = orders.groupBy(patient).agg(F.sum("g").alias("g"), F.sum("r").alias("r"), n_rows().alias("o"))
    return patients.agg(
        F.coalesce(F.sum("g"), F.lit(0)).alias("conflict_groups"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("conflict_rows"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("orders"),
        n_rows().alias("patients"),
    )


def attribute_consistency(rows: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Per attribute, how many keys hold more than one state."""
    states = unpivot_values(rows, attributes, keys).distinct()
    per_key = states.groupBy(*keys, "column_name").agg(n_rows().alias("state_count"))
    return per_key.groupBy("column_name").agg(
        n_rows().alias("key_count"), tally(F.col("state_count") > 1).alias("inconsistent_keys")
    )


# -- times -----------------------------------------------------------------------------------------
def parse_failures(rows: DataFrame, text: str, typed: str) -> DataFrame:
    return rows.agg(
        n_rows().alias("rows"),
        tally(F.col(text).isNull()).alias("missing_text"),
        tally(F.col(text).isNotNull() & F.col(typed).isNull()).alias("unparsed_text"),
    )


def time_agreement(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Distinct key and time pairs of two tables: in both, or in one only."""
    pairs_left = left.select(*keys, time).distinct().withColumn("_l", F.lit(1))
    pairs_right = right.select(*keys, time).distinct().withColumn("_r", F.lit(1))
    on = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, time)])
    joined = pairs_left.alias("a").join(pairs_right.alias("b"), on, "full")
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("agree")
    return joined.groupBy(side.alias("agreement")).agg(n_rows().alias("pair_count"))


# -- grain -----------------------------------------------------------------------------------------
def grain_check(rows: DataFrame, key: str, conditions: dict[str, Column]) -> DataFrame:
    """Rows, distinct keys, and rows meeting each condition.

    Rows are combined per key first, which also serves one very frequent key.
    """
    per_key = rows.groupBy(key).agg(n_rows().alias("n"), *[tally(c).alias(name) for name, c in conditions.items()])
    return per_key.agg(
        F.sum("n").alias("rows"), F.count(key).alias("distinct_keys"), *[F.sum(n).alias(n) for n in conditions]
    )


def layer_counts(layers: Mapping[str, DataFrame], known: Mapping[str, int] | None = None) -> DataFrame:
    """Rows per layer. Layers whose count is ``known``, as one taken while they were written, are not scanned."""
    known = known or {}

    def counted(name: str, frame: DataFrame) -> DataFrame:
        if name in known:
            count = F.lit(known[name]).cast("long")
            return frame.sparkSession.range(1).select(F.lit(name).alias("model_name"), count.alias("row_count"))
        return frame.agg(n_rows().alias("row_count")).select(F.lit(name).alias("model_name"), "row_count")

    return reduce(DataFrame.unionByName, [counted(name, frame) for name, frame in layers.items()])


def grain_preserved(source: DataFrame, derived: DataFrame, key: str) -> DataFrame:
    """Whether an enrichment kept exactly the rows and keys of its source."""

    def per_key(frame: DataFrame, side: str) -> DataFrame:
        return frame.groupBy(key).agg(n_rows().alias("n")).select(F.lit(side).alias("side"), F.col(key).alias("k"), "n")

    sides = per_key(source, "source").unionByName(per_key(derived, "derived"))

    def of(side: str, column: str) -> Column:
        return F.when(F.col("side") == side, F.col(column))

    both = sides.agg(
        *[
            measure.alias(f"{side}_{name}")
            for side in ("source", "derived")
            for name, measure in (
                ("rows", F.coalesce(F.sum(of(side, "n")), F.lit(0))),
                ("unique_keys", F.count(of(side, "k"))),
            )
        ]
    )
    same = (
        (F.col("source_rows") == F.col("derived_rows"))
        & (F.col("source_unique_keys") == F.col("derived_unique_keys"))
        & (F.col("derived_rows") == F.col("derived_unique_keys"))
    )
    return both.select(
        "*",
        (F.col("derived_rows") - F.col("source_rows")).alias("row_difference"),
        F.when(same, "pass").otherwise("fail").alias("validation_status"),
    )


# -- frequencies -----------------------------------------------------------------------------------
def frequency(rows: DataFrame, by: Sequence[str], name: str = "row_count", patient: str | None = None) -> DataFrame:
    """Rows per group, with distinct patients if asked for."""
    if patient is None:
        return rows.groupBy(*by).agg(n_rows().alias(name))
    per_patient = rows.groupBy(*by, patient).agg(n_rows().alias("n"))
    return per_patient.groupBy(*by).agg(F.sum("n").alias(name), F.count(patient).alias("patients"))


def top(rows: DataFrame, order: Sequence[Column | str], limit: int) -> DataFrame:
    return rows.orderBy(*order).limit(limit)


def ranked_within(rows: DataFrame, partition: Sequence[str], order: Sequence[Column | str], rank: str) -> DataFrame:
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def share_within(rows: DataFrame, count: str, partition: Sequence[str], name: str) -> DataFrame:
    """Each row's share of its partition, over an already aggregated table."""
    total = F.sum(count).over(Window.partitionBy(*partition))
    return rows.withColumn(name, safe_pct(F.col(count), total))
