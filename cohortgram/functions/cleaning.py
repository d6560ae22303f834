"""Text cleaning for all-string sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sentinel_to_null(value: str | Column, sentinel: str = "Null", compare: str = "trimmed") -> Column:
    """Trimmed text, with the sentinel turned into NULL.

    ``compare='trimmed'`` trims before it compares, so a padded sentinel becomes NULL too;
    ``compare='raw'`` compares the text as it came, so a padded sentinel stays as text.
    """
    text = _column(value)
    if compare == "trimmed":
        return F.nullif(F.trim(text), F.lit(sentinel))
    if compare == "raw":
        return F.when(text == sentinel, F.lit(None)).otherwise(F.trim(text))
    raise ValueError(f"compare must be 'trimmed' or 'raw', got {compare!r}")


def blank_to_null(value: str | Column) -> Column:
    return F.nullif(F.trim(_column(value)), F.lit(""))


def safe_cast(value: str | Column, data_type: str) -> Column:
    """Typed copy of a text column; text that does not parse becomes NULL."""
    return _column(value).try_cast(data_type)


def punctuation_free(value: str | Column) -> Column:
    """Lower-case letters and digits only, to compare spelling variants of a label."""
    return F.regexp_replace(F.lower(F.trim(_column(value))), "[^a-z0-9]", "")
