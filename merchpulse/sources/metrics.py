"""Metric-table sources.

Whatever the source, the engine needs ``metric_long`` columns; the scan
helpers only project and filter, leaving pushdown to Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchpulse.schema import CODE, KEY, METRIC_CODES, MONTH, VALUE


def read_jdbc(
    spark: SparkSession,
    url: str,
    dbtable: str,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int | None = None,
    properties: dict | None = None,
) -> DataFrame:
    """A JDBC table or ``(sub-query) alias``.

    The published job reads one partition; pass ``partition_column`` with
    bounds and ``num_partitions``, or a list of disjoint ``predicates``
    (e.g. one per key range), to read in parallel.
    """
    props = dict(properties or {})
    if driver:
        props["driver"] = driver
    if fetch_size:
        props["fetchsize"] = str(fetch_size)
    if predicates:
        return spark.read.jdbc(url, dbtable, predicates=list(predicates), properties=props)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable).options(**props)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 1))
        )
    return reader.load()


def project(df: DataFrame, fields: str | Sequence[str] | None = None, condition: str | Column | None = None) -> DataFrame:
    """``load(dbtable, fields[, condition])`` -- projection, then
    predicate.  ``fields`` may be one name or a list."""
    if fields is not None:
        df = df.select(*([fields] if isinstance(fields, str) else list(fields)))
    if condition is not None:
        df = df.where(condition)
    return df


def metric_scan(source: DataFrame, codes: Sequence[str] = METRIC_CODES) -> DataFrame:
    """The four metric columns for the six codes."""
    return source.select(KEY, MONTH, CODE, VALUE).where(F.col(CODE).isin(list(codes)))


def merchant_scan(source: DataFrame, uuid: str, codes: Sequence[str] = METRIC_CODES) -> DataFrame:
    """S4 for one merchant.  The key is a bound literal, never spliced
    into SQL text."""
    return metric_scan(source, codes).where(F.col(KEY) == F.lit(uuid))


def read_metrics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The metric table from files (parquet by default)."""
    return spark.read.format(fmt).load(path)
