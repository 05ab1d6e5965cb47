"""Row-text sinks (K1-K4) and text sources are plain ``DataFrame`` writes.

A row becomes its fields joined by a separator; a null prints as
``None`` and a double as Java prints it (``14500.0``, ``1.23456789E7``),
which is what Spark's cast to string produces.  Not ``csv()``: that quotes
and escapes, the row text is raw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchpulse.plans.periods import _as_date


def row_text(df: DataFrame, sep: str = "\t", null_text: str = "None") -> Column:
    """All columns of a row as one line."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in df.columns]
    return F.concat_ws(sep, *fields)


def rows_to_lines(df: DataFrame, sep: str = "\t") -> DataFrame:
    return df.select(row_text(df, sep).alias("value"))


def write_lines(lines: DataFrame, path: str, single_file: bool = False) -> None:
    """K2/K3: overwrite ``path`` with the ``value`` column as text lines.
    ``single_file`` reproduces the published one-file output; it makes the
    last stage a single task, so it is off by default."""
    out = lines.coalesce(1) if single_file else lines
    out.write.mode("overwrite").text(path)


def write_rows(df: DataFrame, path: str, sep: str = "\t", single_file: bool = False) -> None:
    """K1: rows as separated text lines."""
    write_lines(rows_to_lines(df, sep), path, single_file)


def write_rows_by_key(df: DataFrame, key: str, path: str, sep: str = "\t") -> None:
    """Rows as text lines in a folder for each key; folders of keys that are
    not in ``df`` stay as they are."""
    lines = df.select(F.col(key), row_text(df, sep).alias("value"))
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).text(path)


def _day(as_of) -> str:
    if as_of is None:
        raise ValueError("output paths need the reference date")
    d = _as_date(as_of)
    return f"{d.year:04d}{d.month:02d}/{d.day:02d}"


def online_root(base: str, as_of) -> str:
    return f"{base.rstrip('/')}/online/{_day(as_of)}"


def output_root(base: str, as_of, uuid: str | None = None) -> str:
    """K4: ``<base>/{online/yyyyMM/dd/<uuid> | offline/yyyyMM/dd}``."""
    day = _day(as_of)
    return f"{online_root(base, as_of)}/{uuid}" if uuid is not None else f"{base.rstrip('/')}/offline/{day}"


def output_paths(base: str, as_of, uuid: str | None = None) -> dict[str, str]:
    """K4: the outputs' paths below the run's folder."""
    root = output_root(base, as_of, uuid)
    return {name: f"{root}/{name}" for name in ("quotas", "quotaScores", "finalScores", "rejects")}
