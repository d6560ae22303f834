"""Roll-ups from source rows to a declared grain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.keys import surrogate_key
from cohortgram.functions.measures import n_rows, tally

LINEAGE = ("source_file", "ingested_at")
#: Ranges of keys whose rows are counted before rows are dealt, and the rows a range may hold beyond twice the mean.
RANGES, HEAVY_ROWS = 4096, 100_000


def finest_first(keys: Sequence[str]) -> list[str]:
    """Grouping order of a natural key that runs from coarse to fine.

    Sorts compare a prefix of the first column; one that tells rows apart makes them cheaper.
    """
    return list(reversed(keys))


def latest_lineage(columns: Sequence[str] = LINEAGE) -> list[Column]:
    return [F.max(c).alias(c) for c in columns]


def rows_of(weight: str | None) -> Column:
    """Source rows of a group: its rows, or the sum of ``weight`` where rows were folded before."""
    return n_rows() if weight is None else F.sum(weight)


def dealt_states(
    rows: DataFrame,
    keys: Sequence[str],
    states: Sequence[str],
    latest: Sequence[str],
    key_name: str,
    weight: str,
    parts: int,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Distinct states with their number of rows, shuffled once by the surrogate key of ``keys``.

    Roll-ups that group on that key and more then need no shuffle of their own. Rows of keys with very many rows are folded to
    states before they are dealt, so that no task gets them raw; the others go as they are, since they fold to little less.
    """
    by = finest_first(keys)
    narrow = rows.select(*by, *states, *latest)
    spot = F.pmod(F.xxhash64(*keys), F.lit(RANGES))
    totals = dict(narrow.groupBy(spot.alias("spot")).agg(n_rows()).collect())
    bound = heavy_rows + 2 * sum(totals.values()) // RANGES
    heavy = [i for i, total in totals.items() if total > bound]
    weighed = narrow.withColumn(weight, F.lit(1).cast("long"))
    if heavy:
        folded = narrow.filter(spot.isin(heavy)).groupBy(*by, *states)
        folded = folded.agg(*[F.max(c).alias(c) for c in latest], n_rows().alias(weight))
        weighed = weighed.filter(~spot.isin(heavy)).unionByName(folded)
    key = surrogate_key(*keys)
    dealt = weighed.repartition(parts, key).withColumn(key_name, key)
    return dealt.groupBy(key_name, *by, *states).agg(F.sum(weight).alias(weight), *[F.max(c).alias(c) for c in latest])


def consistent_rollup(
    rows: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    key_name: str,
    conflict: str = "has_order_level_conflict",
    lineage: Sequence[str] = LINEAGE,
    weight: str | None = None,
) -> DataFrame:
    """One row per key; an attribute survives only if all rows of the key agree, NULL being a state.

    Rows are first folded to distinct attribute states by a hash aggregation, map-side as well, so a key
    with very many rows leaves each task as a few states. Agreement is then min = max with either no NULL
    or nothing but NULL; distinct counts per attribute would multiply the rows before the shuffle instead.

    Rows of ``dealt_states`` hold the key already: they are grouped on it first, where they lie.
    """
    # Text cannot be a hash-aggregation buffer: text lineage is folded as a grouping column.
    text = [c for c in lineage if dict(rows.dtypes)[c] == "string"]
    other = [c for c in lineage if c not in text]
    held = [key_name] if key_name in rows.columns else []
    by = [*held, *finest_first(keys)]
    states = rows.groupBy(*by, *attributes, *text).agg(
        rows_of(weight).alias("_rows"), *[F.max(c).alias(c) for c in other]
    )
    total = F.col("_states")
    summary = states.groupBy(*by).agg(
        F.sum("_rows").alias("source_row_count"),
        n_rows().alias("_states"),
        *[F.min(a).alias(f"_min_{a}") for a in attributes],
        *[F.max(a).alias(f"_max_{a}") for a in attributes],
        *[F.count(a).alias(f"_n_{a}") for a in attributes],
        *latest_lineage(lineage),
    )
    agrees = {
        a: F.col(f"_min_{a}").eqNullSafe(F.col(f"_max_{a}")) & ((F.col(f"_n_{a}") == total) | (F.col(f"_n_{a}") == 0))
        for a in attributes
    }
    return summary.select(
        F.col(key_name) if held else surrogate_key(*keys).alias(key_name),
        *keys,
        *[F.when(agrees[a], F.col(f"_max_{a}")).alias(a) for a in attributes],
        (~reduce(lambda x, y: x & y, agrees.values())).alias(conflict),
        "source_row_count",
        *lineage,
    )


def child_rollup(
    rows: DataFrame,
    keys: Sequence[str],
    child: str,
    item: str,
    parent_key: str,
    key_name: str,
    lineage: Sequence[str] = LINEAGE,
    item_counts: bool = True,
    weight: str | None = None,
) -> DataFrame:
    """One row per parent and child label, with item rows, distinct items and a repeat flag.

    The parent key is a function of the natural key, so it is computed rather than joined; rows without a
    full natural key have no parent and are left out. Items are folded first, so distinct ones are counted
    as rows; without ``item_counts`` that step and its shuffle fall away. Rows of ``dealt_states`` hold the parent key already.
    """
    items, distinct_items = f"{item}_result_row_count", f"distinct_{item}_count"
    held = [parent_key] if parent_key in rows.columns else []
    by = [*held, *finest_first(keys)]
    if not item_counts:
        labels = rows.dropna(subset=[*keys, child]).groupBy(*by, child)
        summary = labels.agg(rows_of(weight).alias("source_row_count"), *latest_lineage(lineage))
        keyed = summary if held else summary.withColumn(parent_key, surrogate_key(*keys))
        return keyed.withColumn(key_name, surrogate_key(parent_key, child))
    folded = (
        rows.dropna(subset=[*keys, child])
        .groupBy(*by, child, item)
        .agg(rows_of(weight).alias("_rows"), *latest_lineage(lineage))
    )
    summary = folded.groupBy(*by, child).agg(
        F.sum("_rows").alias("source_row_count"),
        F.sum(F.when(F.col(item).isNotNull(), F.col("_rows")).otherwise(0)).alias(items),
        F.count(item).alias(distinct_items),
        *latest_lineage(lineage),
    )
    if not held:
        summary = summary.withColumn(parent_key, surrogate_key(*keys))
    return summary.select(
        surrogate_key(parent_key, child).alias(key_name),
        parent_key,
        *keys,
        child,
        "source_row_count",
        items,
        distinct_items,
        (F.col(items) > F.col(distinct_items)).alias(f"has_repeated_{item}_records"),
        *lineage,
    )


def without_parent(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Children whose parent is missing: the check behind computing the parent key."""
    return children.join(parents.select(*keys), list(keys), "left_anti")


def repeated_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that own more than one row."""
    return rows.groupBy(*keys).agg(n_rows().alias("row_count")).filter("row_count > 1")


def repeated_summary(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows share a key with another row, and how many rows are surplus copies."""
    groups = rows.groupBy(*keys).agg(n_rows().alias("n"))
    shared = F.when(F.col("n") > 1, F.col("n")).otherwise(0)
    return groups.agg(
        F.sum("n").alias("rows"),
        n_rows().alias("distinct_keys"),
        tally(F.col("n") > 1).alias("keys_with_repeats"),
        F.sum(shared).alias("rows_sharing_a_key"),
        F.sum(F.col("n") - 1).alias("surplus_rows"),
    )
