"""Text-file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its lines joined by newline (LF, CRLF
    or CR in the file) and no newline after the last, columns ``path`` and ``value``."""
    df = spark.read.text(path, wholetext=True)
    lines = F.regexp_replace("value", r"\r\n|\r", "\n")
    return df.select(F.input_file_name().alias("path"), F.regexp_replace(lines, r"\n\z", "").alias("value"))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """S7 for files of any size: ``(path, line, value)``, lines from 1 in each
    file's order; LF, CRLF and CR end a line.

    A large file is read in splits, by as many tasks.  Rows are numbered in
    their split, and a table with a row for each split gives the lines before
    it, so no task holds a whole file.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), "value",
        F.monotonically_increasing_id().alias("id"),  # rising within a task, which reads a split from begin to end
    )
    splits = rows.groupBy("path", "split").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    # one row for each split of a file
    earlier = F.sum("n").over(Window.partitionBy("path").orderBy("split")) - F.col("n")
    begins = splits.select("path", "split", (earlier - F.col("first") + 1).alias("begin"))
    return rows.join(begins, ["path", "split"]).select("path", (F.col("id") + F.col("begin")).alias("line"), "value")
