"""Rounding, ordered sums and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_in_order(columns: list[Column]) -> Column:
    """Columns added from left to right, absent ones as 0, so that the sum of
    doubles does not depend on how rows were partitioned."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0.0))
    return total


def finite(c: Column) -> Column:
    """The value, or null where arithmetic left the range of doubles.  Spark
    orders NaN above infinity, so one comparison covers both."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def retain_decimal(c: Column | str, bits: int = 2) -> Column:
    """Half-up rounding of the value's shortest decimal text.

    Spark's ``round`` on a double goes through the value's decimal text
    and rounds HALF_UP, so 1.005 -> 1.01 and 4999.995 -> 5000.0.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, bits)


def round_half_up_int(c: Column) -> Column:
    """Half-up to an integer for non-negative values (N3): floor(x + 0.5)."""
    return F.floor(c + F.lit(0.5)).cast("bigint")


def safe_div(num: Column, den: Column) -> Column:
    """num / den, or null when den is 0 (a zero divisor makes a quota absent
    instead of failing the run)."""
    return F.when(den != 0, num / den)
