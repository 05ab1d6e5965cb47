"""Date-text cleaning (C2: D12-D16) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published date-text patterns (first match, '' if none).
YEAR_MONTH_DAY = r"\d{4}(/|-)\d{1,2}(/|-)\d{1,2}"
YEAR_MONTH = r"\d{4}(/|-)\d{1,2}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut_year_month_day(text) -> Column:
    """First ``2015-04-03`` / ``2015/4/3``-like part of the text, or ''."""
    return F.regexp_extract(_c(text), YEAR_MONTH_DAY, 0)


def cut_year_month(text) -> Column:
    """First ``2015-04`` / ``2015/4``-like part of the text, or ''."""
    return F.regexp_extract(_c(text), YEAR_MONTH, 0)


def parse_date_text(text, fmt: str = "yyyy-MM-dd", strict: bool = False) -> Column:
    """Text to timestamp by pattern.  Strict parsing: an impossible
    date (month 13) is null here, or an error with ``strict=True``;
    the lenient roll-over of the published helper is not reproduced."""
    return F.to_timestamp(_c(text), F.lit(fmt)) if strict else F.try_to_timestamp(_c(text), F.lit(fmt))


def normalise_separators(text) -> Column:
    """``2015/4/3`` -> ``2015-4-3`` so one pattern reads both spellings."""
    return F.regexp_replace(_c(text), "/", "-")


def reformat_date_text(text, old_fmt: str, new_fmt: str) -> Column:
    """Re-format date text from one pattern to another (null if the
    text does not parse)."""
    return F.date_format(parse_date_text(text, old_fmt), new_fmt)
