"""Repeated and conflicting results: classify, never pick a winner."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.keys import surrogate_key
from cohortgram.functions.measures import n_rows, tally
from cohortgram.operators.rollup import latest_lineage, rows_of

RESOLVED, MISSING, CONFLICT = "resolved", "missing", "conflict"
PARENT = "culture_key"


def reconcile_endpoints(
    rows: DataFrame,
    keys: Sequence[str],
    value: str = "susceptibility",
    lineage: Sequence[str] = ("source_file", "ingested_at"),
    state_counts: bool = True,
    weight: str | None = None,
) -> DataFrame:
    """One row per endpoint: resolved (one value everywhere), missing (only NULL) or conflict.

    A value beside a NULL is a conflict here. Repeated rows of an endpoint, however many, are combined
    map-side. Status and value follow from minimum, maximum and a NULL count in one shuffle;
    ``state_counts`` adds the exact distinct counts of the audit by folding rows to states first, which
    costs a second one, unless the rows lie by one of the keys. ``weight`` holds the source rows of folded rows.
    """
    total, missing = F.col("source_row_count"), F.col("missing_susceptibility_row_count")
    counts: list[Column | str] = ["source_row_count", "missing_susceptibility_row_count"]
    if state_counts:
        states = rows.groupBy(*keys, value).agg(rows_of(weight).alias("_rows"), *latest_lineage(lineage))
        source_rows = F.col("_rows")
        distinct = [
            F.count(value).alias("distinct_nonnull_category_count"),
            n_rows().alias("distinct_result_state_count"),
        ]
        counts += [
            "distinct_nonnull_category_count",
            "distinct_result_state_count",
            F.greatest(total - F.col("distinct_result_state_count"), F.lit(0)).alias("repeated_result_row_count"),
        ]
    else:
        states, source_rows, distinct = rows, F.lit(1) if weight is None else F.col(weight), []
    rolled = states.groupBy(*keys).agg(
        F.sum(source_rows).alias("source_row_count"),
        F.sum(F.when(F.col(value).isNull(), source_rows).otherwise(0)).alias("missing_susceptibility_row_count"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
        *distinct,
        *latest_lineage(lineage),
    )
    resolved = (missing == 0) & (F.col("_low") == F.col("_high"))
    status = F.when(resolved, RESOLVED).when(F.col("_high").isNull(), MISSING).otherwise(CONFLICT)
    return rolled.select(
        *keys,
        *counts,
        status.alias("resolution_status"),
        F.when(resolved, F.col("_high")).alias(value),
        *lineage,
    )


def with_endpoint_keys(
    endpoints: DataFrame, parent_keys: Sequence[str], child: str = "organism"
) -> DataFrame:
    """Culture and culture-organism keys, computed from the natural key instead of joined.

    Rows without a full natural key have no parent record and are left out, as an equality join would.
    """
    keyed = endpoints.dropna(subset=list(parent_keys))
    if PARENT not in endpoints.columns:
        keyed = keyed.withColumn(PARENT, surrogate_key(*parent_keys))
    return keyed.withColumn("culture_organism_key", surrogate_key("culture_key", child))


def resolved_fact(endpoints: DataFrame) -> DataFrame:
    return endpoints.filter(F.col("resolution_status") == RESOLVED).withColumn(
        "susceptibility_key", surrogate_key("culture_organism_key", "antibiotic")
    )


def exceptions(endpoints: DataFrame) -> DataFrame:
    return endpoints.filter(F.col("resolution_status") != RESOLVED)


def scope_groups(scopes: dict[str, tuple[DataFrame, str]], carry: Sequence[str], members: str) -> DataFrame:
    """Union of group tables as (ast_scope, reporting_source_key, carried columns, member keys)."""
    parts = [
        groups.select(F.lit(scope).alias("ast_scope"), F.col(key).alias("reporting_source_key"), *carry, members)
        for scope, (groups, key) in scopes.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def shared_parent(groups: DataFrame, endpoints: DataFrame) -> list[str]:
    """The culture key, if both sides carry it: groups of one culture and the endpoints that lie by it meet without a shuffle."""
    return [PARENT] if PARENT in groups.columns and PARENT in endpoints.columns else []


def reconcile_group(
    groups: DataFrame,
    endpoints: DataFrame,
    keys: Sequence[str],
    members: str = "source_culture_organism_keys",
    member: str = "culture_organism_key",
    result_sets: bool = True,
    parent: Sequence[str] = (),
) -> DataFrame:
    """Second reconciliation: the endpoints of all member records of a group, per antibiotic.

    Unlike the first one it tolerates a missing sibling: one resolved value beside missing endpoints is
    resolved. A member conflict or two resolved values make a conflict. ``result_sets`` adds the audit
    arrays; their size is bounded by the members of one group. ``parent`` names columns that are functions of a group and of
    each of its members: where endpoints lie by them, they are joined and grouped as they lie. They stay in the result.
    """
    member_rows = groups.select(*parent, *keys, F.explode(members).alias(member))
    source = member_rows.join(
        endpoints.select(*parent, member, "antibiotic", "resolution_status", "susceptibility"), [*parent, member]
    )
    resolved_value = F.when(F.col("resolution_status") == RESOLVED, F.col("susceptibility"))
    sets = [
        F.array_sort(F.collect_set(resolved_value)).alias("resolved_results"),
        F.array_sort(F.collect_set("resolution_status")).alias("source_resolution_statuses"),
    ]
    rolled = source.groupBy(*parent, *keys, "antibiotic").agg(
        n_rows().alias("source_endpoint_row_count"),
        tally(F.col("resolution_status") == CONFLICT).alias("source_conflict_count"),
        tally(F.col("resolution_status") == MISSING).alias("source_missing_count"),
        F.min(resolved_value).alias("_low"),
        F.max(resolved_value).alias("_high"),
        *(sets if result_sets else []),
    )
    if result_sets:
        # Endpoints are unique per member and antibiotic, so rows count members and set sizes count values.
        rolled = rolled.withColumn("source_organisms_with_endpoint", F.col("source_endpoint_row_count")).withColumn(
            "distinct_resolved_result_count", F.size("resolved_results").cast("long")
        )
    return classify_group(rolled).drop("_low", "_high")


def classify_group(rolled: DataFrame) -> DataFrame:
    """Status, value and reason code of a rolled-up group endpoint."""
    source_conflict = F.col("source_conflict_count") > 0
    discordant = F.col("_low") != F.col("_high")
    single = F.col("_low") == F.col("_high")
    return rolled.select(
        "*",
        F.when(source_conflict | F.coalesce(discordant, F.lit(False)), CONFLICT)
        .when(single, RESOLVED)
        .otherwise(MISSING)
        .alias("resolution_status"),
        F.when(~source_conflict & single, F.col("_low")).alias("susceptibility"),
        F.when(source_conflict, "source_endpoint_conflict")
        .when(discordant, "discordant_source_results")
        .when(single & (F.col("source_missing_count") > 0), "resolved_with_missing_source_endpoint")
        .when(single, "resolved_consistent_result")
        .otherwise("missing_only")
        .alias("reconciliation_reason"),
    )


def with_group_endpoint_key(endpoints: DataFrame) -> DataFrame:
    return endpoints.withColumn(
        "reporting_culture_susceptibility_key", surrogate_key("ast_scope", "reporting_source_key", "antibiotic")
    )


def single_value(values: str) -> Column:
    """The element of a one-element array, else NULL; larger and empty arrays are not an error."""
    return F.when(F.size(values) == 1, F.try_element_at(F.col(values), F.lit(1)))
