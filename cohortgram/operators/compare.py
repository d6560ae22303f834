"""Comparing two large relations by fingerprints first and by rows only where these differ.

The rows of each side are dealt to buckets by their key, and a bucket is summed up as its number of rows and the sums of the halves of their
64-bit hashes, whatever their order. Equal rows give equal sums, so only buckets of unlike sums need a look at their rows; they are split
once more in the same way, into as many leaves each. Sums fold before the shuffle: per task at most ``BUCKETS`` rows of four numbers leave, and
equal relations shuffle nothing else. What is broadcast are numbers of buckets and leaves, at most ``BUCKETS`` and ``LEAVES`` rows; beyond ``LEAVES``
unlike leaves whole buckets are compared.

Each side is read up to three times, so both should be stored. NULL equals NULL, in keys too. Repeated rows count as often as they
stand there. Two unlike buckets have equal sums with a probability near 2^-64.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgram.functions.measures import n_rows

BUCKETS = 4096
#: Unlike leaves whose numbers are sent to all tasks: 16 bytes each.
LEAVES = 1 << 18
_HALF = (1 << 32) - 1


def row_hash(columns: Sequence[str]) -> Column:
    """A 64-bit hash. Spark's own skips NULLs, so which columns are NULL goes into it as well."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def _places(keys: Sequence[str], buckets: int) -> tuple[Column, Column]:
    """Bucket of a row, and leaf inside it, from separate parts of the key's hash."""
    key = row_hash(keys)
    return F.pmod(key, F.lit(buckets)), F.pmod(F.shiftrightunsigned(key, 32), F.lit(buckets))


def fingerprints(rows: DataFrame, by: Sequence[str], value: str = "_row") -> DataFrame:
    """``by, n, low, high``: order-free sums of the hashes in ``value``."""
    return rows.groupBy(*by).agg(
        n_rows().alias("n"),
        F.sum(F.col(value).bitwiseAND(F.lit(_HALF))).alias("low"),
        F.sum(F.shiftrightunsigned(value, 32)).alias("high"),
    )


def _unlike(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    sums = F.struct("n", "low", "high")
    sides = [fingerprints(side, by).select(*by, sums.alias(name)) for side, name in ((left, "_l"), (right, "_r"))]
    return sides[0].join(sides[1], list(by), "full").where(~F.col("_l").eqNullSafe(F.col("_r"))).select(*by)


def suspects(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS, leaves: int = LEAVES
) -> tuple[DataFrame, DataFrame]:
    """Both sides cut down to the leaves in which they differ: ``keys`` and ``values``, which both must have."""
    bucket, leaf = _places(keys, buckets)
    columns = [*keys, *values]
    placed = [
        side.select(*columns, row_hash(columns).alias("_row"), bucket.alias("_bucket"), leaf.alias("_leaf")) for side in (left, right)
    ]
    unlike = F.broadcast(_unlike(*placed, ["_bucket"]))
    inside = [side.join(unlike, "_bucket", "left_semi") for side in placed]
    found = _unlike(*inside, ["_bucket", "_leaf"])
    # One more than fit means that there are too many to name: then the buckets have to do.
    named = F.broadcast(found.limit(leaves + 1))
    few = named.agg((n_rows() <= leaves).alias("few")).scalar()
    whole = [side.where(~few) for side in inside]
    cut = [side.join(named, ["_bucket", "_leaf"], "left_semi").where(few) for side in inside]
    return tuple(a.unionByName(b).select(*columns) for a, b in zip(cut, whole))


def differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS, leaves: int = LEAVES
) -> DataFrame:
    """``keys, values, left_rows, right_rows``: rows that one side holds more often than the other."""
    columns = [*keys, *values]
    sides = suspects(left, right, keys, values, buckets, leaves)
    marked = [
        side.select(*columns, F.lit(a).cast("long").alias("_l"), F.lit(1 - a).cast("long").alias("_r")) for a, side in zip((1, 0), sides)
    ]
    counted = marked[0].unionByName(marked[1]).groupBy(*columns)
    return counted.agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows")).where("left_rows <> right_rows")
