"""Written intermediate tables and shipping of this package to the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchpulse.session import file_system, shared_path

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not find it on
    their path (a session started from another folder)."""
    root, app = os.path.dirname(_PACKAGE), spark.sparkContext.applicationId
    if app in _shipped or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="merchpulse-code-"), "merchpulse_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


#: Spark's own setting: the shuffle files of a query go when it is done.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: the
    lineage ends there, and a lost executor loses none of it.  The shuffle
    files behind it go when it is written."""
    spark = df.sparkSession
    path, held = shared_path(spark, name), spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if held is None else spark.conf.set(_CLEAN, held)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def done_with(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made, when nothing reads them any more."""
    for t in tables:
        fs, to_path = file_system(t.sparkSession, t.written_to)
        fs.delete(to_path(t.written_to), True)


def rows_with_key(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text)`` as bigint and string, whatever else ``df`` carries."""
    return df.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias(text))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null counts as empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def text_slices(batches, limit: int, text: str = "text"):
    """Cut Arrow batches into runs of whole rows of at most ``limit`` text
    bytes (a longer text stands alone); yields the rows and their bytes."""
    for batch in batches:
        texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
        first = size = 0
        for i, t in enumerate(texts):
            if i > first and size + len(t) > limit:
                yield batch.slice(first, i - first), texts[first:i]
                first, size = i, 0
            size += len(t)
        if first < len(texts):
            yield batch.slice(first), texts[first:]
