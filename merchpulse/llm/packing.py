"""Packing: optimal length buckets and token-budget batches.

A dynamic program over the global histogram of lengths chooses the bucket
boundaries that minimise padding; inside each bucket, documents form batches
whose padded size keeps to a token budget.

A document's length is its words (runs of bytes other than space, tab, LF,
VT, FF, CR) plus one end token, so that null and empty texts have length 1.
The histogram has a cell for each length up to 4096 and, above, for each
value of a length's highest twelve bits, so the driver's table stays below
100,000 cells for any input; a cell counts with its longest document, which
makes the program exact over boundaries between cells.

Defined cases: repeated rows are packed each for itself; a document longer
than the budget is a batch of its own; ties go to the smaller boundary; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchpulse.llm.tables import written

BUCKETS = 8
TOKEN_BUDGET = 65_536
#: Documents of a bucket are dealt over groups of about this many, each of
#: which forms its own batches, so that no task holds a whole bucket.
GROUP_ROWS = 50_000
EXACT_LENGTHS = 4096


def with_length(docs: DataFrame) -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (words + 1).cast("bigint").alias("n_tokens"))


def cell_of(length: str) -> Column:
    """Exact to 4096, then the length with all but its top twelve bits cleared."""
    shift = f"greatest(length(bin({length})) - 12, 0)"
    return F.when(F.col(length) <= EXACT_LENGTHS, F.col(length)).otherwise(
        F.expr(f"shiftleft(shiftright({length}, {shift}), {shift})")
    )


def optimal_boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Boundaries (longest lengths) of at most ``buckets`` buckets with the
    least padded tokens.  ``histogram``: (length, documents), ascending.

    cost[b][j] = min over i < j of cost[b-1][i] + length_j * (docs_j - docs_i)
    is a minimum of lines in length_j with slopes -docs_i that fall as i
    grows, so each layer is one pass with a hull of lines.
    """
    if not histogram:
        return []
    lengths = [0] + [x for x, _ in histogram]
    docs = [0]
    for _, n in histogram:
        docs.append(docs[-1] + n)
    m = len(histogram)
    cost: list[float] = [0] + [float("inf")] * m
    back: list[list[int]] = []
    for _ in range(min(buckets, m)):
        hull: deque[tuple[int, int, int]] = deque()  # slope, intercept, i
        new, frm = [float("inf")] * (m + 1), [0] * (m + 1)
        for j in range(1, m + 1):
            i = j - 1
            if cost[i] != float("inf"):
                line = (-docs[i], cost[i], i)
                while len(hull) >= 2 and _hidden(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            while len(hull) >= 2 and _at(hull[1], lengths[j]) < _at(hull[0], lengths[j]):
                hull.popleft()
            if hull:
                new[j], frm[j] = _at(hull[0], lengths[j]) + lengths[j] * docs[j], hull[0][2]
        back.append(frm)
        cost = new
    # with as many buckets as lengths, or fewer: more buckets never cost more
    out, j = [], m
    for frm in reversed(back):
        out.append(lengths[j])
        j = frm[j]
    return out[::-1]


def _at(line, x):
    return line[0] * x + line[1]


def _hidden(a, b, c) -> bool:
    """Whether line ``b`` is nowhere strictly below both neighbours."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def length_histogram(lengths: DataFrame) -> list[tuple[int, int]]:
    """(longest length, documents) by cell, ascending; bounded by the cells."""
    cells = lengths.groupBy(cell_of("n_tokens").alias("cell")).agg(
        F.max("n_tokens").alias("length"), F.count(F.lit(1)).alias("n")
    )
    return sorted((r["length"], r["n"]) for r in cells.collect())


def pack(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """``doc_id, n_tokens, bucket, bucket_length, batch_id, slot, padding``.

    Batch ids are unique over the whole result: bucket, group and batch in
    the group, as text ``b-g-n``.
    """
    spark: SparkSession = docs.sparkSession
    lengths = written(with_length(docs), "lengths")
    histogram = length_histogram(lengths)
    bounds = optimal_boundaries(histogram, buckets)
    if not bounds:
        bounds = [1]
    rows, lo = [], 0
    for b, hi in enumerate(bounds):
        n = sum(c for x, c in histogram if lo < x <= hi)
        rows.append((b, lo, hi, max(1, token_budget // hi), -(-n // group_rows) or 1))
        lo = hi
    bucket = F.lit(len(bounds) - 1)
    for b in reversed(range(len(bounds) - 1)):
        bucket = F.when(F.col("n_tokens") <= bounds[b], F.lit(b)).otherwise(bucket)
    table = spark.createDataFrame(rows, "bucket int, lo long, bucket_length long, per_batch long, groups long")
    dealt = (
        lengths.withColumn("bucket", bucket)
        .join(F.broadcast(table), "bucket")  # at most `buckets` rows
        .withColumn("grp", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.col("groups")))
    )
    place = F.row_number().over(Window.partitionBy("bucket", "grp").orderBy("n_tokens", "doc_id")) - 1
    n = F.col("place").cast("bigint")
    return dealt.withColumn("place", place).select(
        "doc_id", "n_tokens", "bucket", "bucket_length",
        F.concat_ws("-", "bucket", "grp", F.floor(n / F.col("per_batch")).cast("bigint")).alias("batch_id"),
        F.pmod(n, F.col("per_batch")).alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )
