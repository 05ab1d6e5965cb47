"""Calendar enrichment (C1: D1-D11) as column expressions.

The published helpers read the wall clock on the driver; here each takes
a timestamp (or date) column, so a whole table is enriched in one
projection.  ``fmt`` is a Spark datetime pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# units accepted by time_ago
UNITS = ("YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_ts(ts, fmt: str = "yyyy-MM-dd") -> Column:
    """The timestamp as text."""
    return F.date_format(_c(ts), fmt)


def time_ago(ts, m: int, unit: str = "DAY") -> Column:
    """``m`` units before ``ts``; months and years clamp to the month
    end (2016-03-31 minus a month is 2016-02-29)."""
    unit = unit.upper()
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    return F.timestamp_add(unit, F.lit(-int(m)), _c(ts))


def days_ago(ts, m: int = 0, fmt: str = "yyyy-MM-dd") -> Column:
    """D2."""
    return format_ts(time_ago(ts, m, "DAY"), fmt)


def months_ago(ts, m: int = 0, fmt: str = "yyyy-MM-dd") -> Column:
    """D3."""
    return format_ts(time_ago(ts, m, "MONTH"), fmt)


def year_ago(ts, m: int = 0, fmt: str = "yyyy-MM-dd") -> Column:
    """D4 (2016-02-29 minus a year is 2015-02-28)."""
    return format_ts(time_ago(ts, m, "YEAR"), fmt)


def months_ago_with_max_day(ts, m: int = 0, fmt: str = "yyyy-MM-dd") -> Column:
    """Last day of the month ``m`` months before."""
    return F.date_format(F.last_day(time_ago(ts, m, "MONTH")), fmt)


def week_bounds(ts, m: int = 0, fmt: str = "yyyy-MM-dd") -> tuple[Column, Column]:
    """Monday and Sunday of the ISO week ``m`` weeks before (a Sunday
    belongs to the week that started the Monday before).  Computed on the
    calendar date, so wall-clock timestamps give the same week in any
    session time zone."""
    d = F.to_date(_c(ts))
    # dayofweek: Sunday = 1 ... Saturday = 7; days since Monday = (dow + 5) mod 7
    monday = F.date_sub(F.date_sub(d, F.pmod(F.dayofweek(d) + F.lit(5), F.lit(7))), 7 * int(m))
    return F.date_format(monday, fmt), F.date_format(F.date_add(monday, 6), fmt)


def quarter_start(ts, fmt: str = "yyyy-MM-dd") -> Column:
    """First day of the quarter, keeping the time of day (built from the
    timestamp's own fields, so it does not depend on the session zone)."""
    t = _c(ts)
    seconds = F.date_format(t, "ss.SSSSSS").cast("decimal(8,6)")
    first_month = (F.quarter(t) - F.lit(1)) * F.lit(3) + F.lit(1)
    start = F.make_timestamp_ntz(F.year(t), first_month, F.lit(1), F.hour(t), F.minute(t), seconds)
    return F.date_format(start, fmt)


def days_in_month(ts) -> Column:
    """D9."""
    return F.dayofmonth(F.last_day(_c(ts)))


def calendar_parts(ts) -> tuple[Column, Column, Column]:
    """Year, month (1-12), day of month."""
    return F.year(_c(ts)), F.month(_c(ts)), F.dayofmonth(_c(ts))


def millis_to_text(millis, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch milliseconds as text in the session time zone."""
    return F.date_format(F.timestamp_millis(_c(millis)), fmt)


def enrich(df, ts: str, m: int = 1, fmt: str = "yyyy-MM-dd"):
    """Add the calendar columns for one timestamp column."""
    y, mo, d = calendar_parts(ts)
    wb, we = week_bounds(ts, m, fmt)
    return df.select(
        "*",
        format_ts(ts, fmt).alias("as_text"),
        days_ago(ts, m, fmt).alias("days_ago"),
        months_ago(ts, m, fmt).alias("months_ago"),
        year_ago(ts, m, fmt).alias("year_ago"),
        months_ago_with_max_day(ts, m, fmt).alias("month_end_ago"),
        wb.alias("week_begin"),
        we.alias("week_end"),
        quarter_start(ts, fmt).alias("quarter_start"),
        days_in_month(ts).alias("days_in_month"),
        y.alias("year"),
        mo.alias("month"),
        d.alias("day"),
    )
