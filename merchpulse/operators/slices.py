"""Metric slices (P1-P4): filter, typed parse, distinct.

A slice is ``(property_uuid, target_time, value)`` for one metric code and
one month range, distinct **after** parsing: ``300`` and ``300.0`` collapse,
two different values for one month both stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from merchpulse.plans.periods import Periods
from merchpulse.schema import CODE, KEY, METRIC_CODES, MONTH, PARSE_KIND, SALE_AMOUNT, VALUE
from merchpulse.session import SharedTable

MONTH_PATTERN = r"^\d{4}(0[1-9]|1[0-2])$"


def parse_text(kind: str, text: Column) -> Column:
    """Text to double by parse kind, null if unparsable (T1 for percents).

    ``int`` is parsed as an int, so ``12.0`` is rejected as in the
    published job, then widened to double, which is exact.
    """
    if kind == "percent":
        text = F.regexp_replace(text, "%", "")
        kind = "double"
    return text.try_cast(kind).cast("double")


def parsed_value(code: Column, text: Column, kinds: dict = PARSE_KIND) -> Column:
    """One double column holding each row's value parsed by its code's kind."""
    expr = None
    for c, kind in kinds.items():
        branch = parse_text(kind, text)
        expr = F.when(code == c, branch) if expr is None else expr.when(code == c, branch)
    return expr


#: Why a row cannot be used.
REASONS = ("null value", "bad month", "unparsable value", "non-finite value")


def bad_row_reason(month: Column, text: Column, value: Column) -> Column:
    """Why a row cannot be used, or null.  ``value`` is the try-parsed value."""
    return (
        F.when(text.isNull(), F.lit("null value"))
        .when(month.isNull() | ~month.rlike(MONTH_PATTERN), F.lit("bad month"))
        .when(value.isNull(), F.lit("unparsable value"))
        .when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), F.lit("non-finite value"))
    )


def windowed_rows(metrics: DataFrame, p: Periods, codes=METRIC_CODES) -> DataFrame:
    """Rows of the six codes in the window, plus year-earlier sales (S4 + P2).

    Plain column predicates on the scan's own columns, so Catalyst pushes
    them into the parquet/JDBC scan.
    """
    in_window = F.col(MONTH).between(p.start, p.end)
    in_ye = (F.col(CODE) == SALE_AMOUNT) & F.col(MONTH).between(p.ye_start, p.ye_end)
    # implied by the two windows, but on the month alone: Catalyst can push
    # it through projections, unpivots and aggregations keyed by month,
    # and a month-sorted table skips row groups with it
    span = F.col(MONTH).between(p.ye_start, p.end)
    return metrics.select(KEY, MONTH, CODE, VALUE).where(
        F.col(CODE).isin(list(codes)) & span & (in_window | in_ye)
    )


def parse_rows(rows: DataFrame, on_bad: str = "fail", kinds: dict = PARSE_KIND):
    """Add a double ``value`` column parsed per code.

    ``on_bad='fail'`` raises on a null or unparsable value or a malformed
    month, as the published job fails.  ``on_bad='quarantine'`` returns
    ``(good, rejects)`` where rejects carry a ``reason`` column.
    """
    tried = parsed_value(F.col(CODE), F.col(VALUE), kinds)
    reason = bad_row_reason(F.col(MONTH), F.col(VALUE), tried)
    if on_bad == "fail":
        message = F.concat_ws(" ", F.lit("bad metric row:"), reason, F.col(KEY), F.col(MONTH), F.col(CODE))
        checked = F.when(reason.isNotNull(), F.raise_error(message)).otherwise(tried)
        return rows.withColumn("value", checked.cast("double"))
    if on_bad == "quarantine":
        tagged = rows.withColumn("value", tried).withColumn("reason", reason)
        good = tagged.where(F.col("reason").isNull()).drop("reason")
        bad = tagged.where(F.col("reason").isNotNull()).drop("value")
        return good, bad
    raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")


def distinct_values(parsed: DataFrame) -> DataFrame:
    """Distinct ``(key, month, code, value)`` after parsing.

    One shuffle on all four columns with a map-side partial distinct, so
    repeated rows of a hot merchant collapse before they leave the mapper.
    """
    return parsed.select(KEY, MONTH, CODE, "value").distinct()


def base_values(metrics: DataFrame, p: Periods, on_bad: str = "fail") -> DataFrame:
    """Scan, filter, parse and de-duplicate once; every quota reads this."""
    return base_and_rejects(metrics, p, on_bad)[0]


def base_and_rejects(metrics: DataFrame, p: Periods, on_bad: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """The base values and, with ``quarantine``, the rejected rows; lazy, each
    with a scan of its own (``split_rows`` has both from one)."""
    rows = windowed_rows(metrics, p)
    if on_bad != "quarantine":
        return distinct_values(parse_rows(rows, on_bad=on_bad)), None
    good, bad = parse_rows(rows, on_bad=on_bad)
    return distinct_values(good), bad


def split_rows(metrics: DataFrame, p: Periods) -> tuple[DataFrame, DataFrame, dict[str, int], SharedTable]:
    """V3 in one pass over the source: the base values, the rejected rows, how
    many rows each reason rejected, and the table behind both.

    The window's rows are parsed once and written by outcome, so good values
    and rejects are folders of one table; the counts are observed during that
    write.
    """
    tried = windowed_rows(metrics, p).withColumn("value", parsed_value(F.col(CODE), F.col(VALUE)))
    tagged = tried.withColumn("reason", bad_row_reason(F.col(MONTH), F.col(VALUE), F.col("value")))
    # a good row needs no text any more, a rejected one no value
    good = F.col("reason").isNull()
    tagged = tagged.select(
        KEY, MONTH, CODE, F.when(~good, F.col(VALUE)).alias(VALUE), F.when(good, F.col("value")).alias("value"), "reason",
        F.when(good, F.lit("good")).otherwise(F.lit("rejected")).alias("outcome"),
    )
    seen = Observation()
    counts = [F.count_if(F.col("reason") == r).alias(r.replace(" ", "_").replace("-", "_")) for r in REASONS]
    table = SharedTable.write(tagged.observe(seen, F.count_if(good).alias("good"), *counts), "outcomes", "outcome")
    found = seen.get
    base = distinct_values(table.frame.where("outcome = 'good'"))
    rejects = table.frame.where("outcome = 'rejected'").select(KEY, MONTH, CODE, VALUE, "reason")
    return base, rejects, {r: found[r.replace(" ", "_").replace("-", "_")] for r in REASONS}, table


def shared_slices(base: DataFrame) -> SharedTable:
    """The base values as a table in folders by code, for plans that read
    them once for each quota: a slice reads its code's folder alone."""
    return SharedTable.write(base.select(KEY, MONTH, CODE, "value"), "slices", CODE)


def metric_slice(
    metrics: DataFrame, code: str, start: str, end: str, kind: str | None = None, on_bad: str = "fail"
) -> DataFrame:
    """``getLastNMonthInfoBy`` (P1): one code, inclusive text month range,
    typed parse, distinct over ``(key, month, value)``."""
    kind = kind or PARSE_KIND[code]
    rows = metrics.select(KEY, MONTH, VALUE, CODE).where(
        (F.col(CODE) == code) & (F.col(MONTH) >= start) & (F.col(MONTH) <= end)
    )
    parsed = parse_rows(rows, on_bad=on_bad, kinds={code: kind})
    if isinstance(parsed, tuple):
        parsed = parsed[0]
    out = parsed.select(KEY, MONTH, "value").distinct()
    if kind == "int":
        out = out.withColumn("value", F.col("value").cast("int"))
    return out
