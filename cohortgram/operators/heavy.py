"""The keys with the most rows, exact, without a count of every key.

The first pass counts rows per hash bucket, under two hashes. A bucket's total is an upper bound of the rows of each key in it; totals add
up from task to task, so the shuffle carries at most ``2 * BUCKETS`` numbers per task whatever the number of keys. The second pass counts the
keys exactly that lie in heavy buckets under both hashes. Their top-th count c proves the list complete if no other bucket
reaches c, for then no other key does. Otherwise a last pass counts the keys whose buckets all reach c, among which the whole list must be;
on a table without heavy keys that is nearly every key, and they are then all counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.measures import n_rows
from cohortgram.operators.profile import largest_keys
from cohortgram.plans.storage import Scratch

#: Buckets of each hash: what the driver sees of the table is two totals for each.
BUCKETS = 1 << 16
#: Heavy buckets a first look takes for each key asked for.
FIRST = 4
#: Buckets the rows are filtered by at most; if more are in question, all keys are counted.
MOST = 4096


def heavy_keys(rows: DataFrame, keys: Sequence[str], top: int, scratch: Scratch, name: str = "heavy_keys", buckets: int = BUCKETS) -> DataFrame:
    """The ``top`` keys by rows, ties to the smaller key, as ``largest_keys`` gives them: all, if there are fewer.

    A null is a key of its own. No rows give no rows.
    """
    narrow = rows.select(*keys)
    hashes = _hashes(narrow, buckets)
    totals = _totals(narrow, hashes)
    first = sorted(totals[0].values(), reverse=True)[: FIRST * top]
    if not first:
        return largest_keys(narrow, keys, top)
    found = scratch.keep(f"{name}-first", _counted(narrow, keys, top, hashes, totals, first[-1]), rows=top)
    held, least = found.agg(n_rows(), F.min("row_count")).first()
    # Keys not counted have fewer rows than the least total of the buckets looked into.
    if held == top and first[-1] <= least:
        return found
    return _counted(narrow, keys, top, hashes, totals, least if held == top else 1)


def _hashes(rows: DataFrame, buckets: int) -> tuple[str, str]:
    """Two bucket numbers as SQL. Floating point is left out of them, as equal keys may differ in their bits."""
    plain = [f"`{f.name.replace('`', '``')}`" for f in rows.schema if not {"float", "double"} & set(_type_words(f))]
    listed = ", ".join(plain) or "0"
    return f"pmod(xxhash64({listed}), {buckets})", f"pmod(hash({listed}), {buckets})"


def _type_words(field) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in field.dataType.simpleString()).split()


def _totals(rows: DataFrame, hashes: tuple[str, str]) -> tuple[dict[int, int], dict[int, int]]:
    """Rows per bucket of each hash: at most two numbers for each bucket, whatever the table."""
    sides = ", ".join(f"struct({i} AS side, cast({h} AS long) AS bucket)" for i, h in enumerate(hashes))
    counted = rows.select(F.expr(f"inline(array({sides}))")).groupBy("side", "bucket").agg(n_rows().alias("total"))
    totals: tuple[dict[int, int], dict[int, int]] = ({}, {})
    for side, bucket, total in counted.collect():
        totals[side][bucket] = total
    return totals


def _counted(
    rows: DataFrame,
    keys: Sequence[str],
    top: int,
    hashes: tuple[str, str],
    totals: tuple[dict[int, int], dict[int, int]],
    at_least: int,
) -> DataFrame:
    """The largest of the keys whose buckets all reach a total; other keys have fewer rows than it."""
    for expression, of_side in zip(hashes, totals):
        reaching = [str(bucket) for bucket, total in of_side.items() if total >= at_least]
        if len(reaching) <= MOST and len(reaching) < len(of_side):
            rows = rows.filter(F.expr(f"{expression} IN ({', '.join(reaching)})"))
    return largest_keys(rows, keys, top)
