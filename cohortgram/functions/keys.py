"""Deterministic keys built from natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token for a NULL part and the separator between parts, as the public
# dbt-utils surrogate-key macro writes them, so keys stay comparable with tables made by it.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of ``columns``; equal natural keys always give equal keys."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(NULL_TOKEN)) for p in parts]))


def packed(key: str | Column) -> Column:
    """A surrogate key in 17 bytes instead of 32 characters, for shuffles that only compare keys.

    Texts have equal bytes only if they are equal: lower-case hex is packed behind a 1, other text stands as it is behind a 0. NULL stays NULL.
    """
    text = F.col(key) if isinstance(key, str) else key
    raw = F.unhex(text)
    plain = F.concat(F.lit(b"\x00"), text.cast("binary"))
    return F.when(F.lower(F.hex(raw)) == text, F.concat(F.lit(b"\x01"), raw)).otherwise(plain)
