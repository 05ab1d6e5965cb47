"""Analysis windows (P5, P6) from an explicit reference date.

The window is the ``n`` full months before the reference month; the
year-earlier window is the same months twelve months back.  Months are
``yyyyMM`` text compared as text, as in the input table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from merchpulse.schema import WINDOW_MONTHS


def _as_date(as_of) -> dt.date:
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    if isinstance(as_of, dt.date):
        return as_of
    return dt.date.fromisoformat(str(as_of)[:10])


def months_ago(as_of, m: int) -> str:
    """``yyyyMM`` of the month ``m`` months before ``as_of`` (D3 for the
    month grain: the day of month does not matter)."""
    d = _as_date(as_of)
    idx = d.year * 12 + (d.month - 1) - m
    return f"{idx // 12:04d}{idx % 12 + 1:02d}"


def next_month(month: str) -> str:
    idx = int(month[:4]) * 12 + int(month[4:6]) - 1 + 1
    return f"{idx // 12:04d}{idx % 12 + 1:02d}"


@dataclass(frozen=True)
class Periods:
    start: str
    end: str
    ye_start: str
    ye_end: str
    months: tuple[str, ...]  # the window's months, oldest first
    n: int

    @property
    def ye_months(self) -> tuple[str, ...]:
        return tuple(str(int(m) - 100) for m in self.months)


def periods(as_of, n: int = WINDOW_MONTHS) -> Periods:
    """Window ``[as_of - n months, as_of - 1 month]`` and the year-earlier
    window ``[as_of - (n + 12) months, as_of - 13 months]``."""
    months = tuple(months_ago(as_of, i) for i in range(n, 0, -1))
    return Periods(
        start=months_ago(as_of, n),
        end=months_ago(as_of, 1),
        ye_start=months_ago(as_of, n + 12),
        ye_end=months_ago(as_of, 13),
        months=months,
        n=n,
    )
