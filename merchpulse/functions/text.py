"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java's String.trim removes every char <= U+0020 at both ends; Spark's
# trim removes only spaces.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_percent(text) -> Column:
    """Remove every ``%``."""
    return F.regexp_replace(_c(text), "%", "")


def java_trim(text) -> Column:
    """Trim control characters and spaces at both ends, as Java does."""
    return F.regexp_replace(_c(text), _JAVA_TRIM, "")


def trim_array(arr) -> Column:
    """Trim every string of an array column.  (A one-argument lambda:
    passing ``F.trim`` itself would receive the element index as its second
    argument.)"""
    return F.transform(_c(arr), lambda z: java_trim(z))


def trim_row(df: DataFrame) -> DataFrame:
    """Every field as trimmed text."""
    return df.select(*[java_trim(F.col(c).cast("string")).alias(c) for c in df.columns])
