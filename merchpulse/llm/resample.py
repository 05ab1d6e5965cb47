"""Target-distribution importance resampling over hashed word runs.

Texts are lower-cased (A-Z), cut into words and dictionary-encoded with Arrow
kernels, a few megabytes at a time.  Runs of several words come from shifted
dictionary indices; each *distinct* pair (run, next word) gets one CRC, that of
the run carried on over a space and the word.  A feature's bucket is its CRC
modulo ``buckets``; counts of buckets are summed over all documents and over
all target texts, and a bucket's gain is the floored log ratio of the two
smoothed shares.  A second pass takes each feature's gain and sums the segments
of the documents.

The draw without replacement is the Gumbel top-k: the weight plus Gumbel noise
that a hash of the document's id fixes.  Ranks come from a range partitioning
of ``(score, doc_id)``: rows are numbered inside each range, and the sizes of
the earlier ranges (one row for each range) are added.

Sizes: a task holds one slice of text and ``buckets`` counts; what the driver
and the broadcast hold is ``buckets`` gains, whatever the input's size.

Defined results: a null or empty text has no features and weight 0.  A row
without an id has a weight, but no score, is not counted among the N and not
drawn.  Rows that repeat an id are documents of their own (rows that repeat id
and text tie; either order is the same).  With no documents the result is
empty; with no target texts T is 0.  Other columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchpulse.llm.tables import rows_with_key, ship_package, written

#: What stands between words: ASCII but digits and letters (after lower-casing).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLICE_BYTES = 4 << 20


def text_runs(column: pa.Array, limit: int = SLICE_BYTES):
    """Cut a string column into runs of rows of at most ``limit`` bytes each
    (a longer text stands alone); yields first row and the run."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        used = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, used + limit, side="right")))
        yield first, texts.slice(first, last - first)
        first = last


def features(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Words of each text, and for each run length the distinct features'
    buckets, every feature's place among them, and its text's row."""
    words = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    offsets = words.offsets.to_numpy()
    coded = pc.dictionary_encode(pc.list_flatten(words))
    spelled = [w.encode() for w in coded.dictionary.to_pylist()]
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    index = coded.indices.to_numpy().astype(np.int64)
    if b"" in spelled:  # before a leading and after a trailing separator
        some = index != spelled.index(b"")
        row, index = row[some], index[some]
    n_words = np.bincount(row, minlength=len(texts))
    crc = np.array([zlib.crc32(w) for w in spelled], np.int64)
    found, codes, rows = [crc % buckets], [index], [row]
    run, run_crc, run_row = index, crc, row
    for length in range(2, longest + 1):
        # a run of `length` words: the run one shorter and the word after it
        inside = run_row[: len(run) - 1] == row[length - 1 :] if len(run) else np.zeros(0, bool)
        pair = run[: len(inside)][inside] * max(len(spelled), 1) + index[length - 1 :][inside]
        different, place = np.unique(pair, return_inverse=True)
        before, word = np.divmod(different, max(len(spelled), 1))
        longer = np.array([zlib.crc32(b" " + spelled[w], int(run_crc[b])) for b, w in zip(before, word)], np.int64)
        found.append(longer % buckets)
        codes.append(place.astype(np.int64))
        rows.append(run_row[: len(inside)][inside])
        # runs that end a text drop out of step with `index`, so keep a place for each word
        full = np.zeros(len(inside), np.int64)
        full[inside] = place
        run, run_crc = full, longer if len(longer) else np.zeros(1, np.int64)
        run_row = np.where(inside, run_row[: len(inside)], -1)
    return n_words, found, codes, rows


def _count(longest: int, buckets: int):
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in text_runs(batch.column("text")):
                _, found, codes, _ = features(texts, longest, buckets)
                for bucket, code in zip(found, codes):
                    np.add.at(total, bucket, np.bincount(code, minlength=len(bucket)))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return count


def _weigh(longest: int, buckets: int, gains):
    def weigh(batches):
        gain = gains.value
        for batch in batches:
            for first, texts in text_runs(batch.column("text")):
                n_words, found, codes, rows = features(texts, longest, buckets)
                n, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                for bucket, code, row in zip(found, codes, rows):
                    if len(row):
                        some, begin = np.unique(row, return_index=True)
                        weight[some] += np.add.reduceat(gain[bucket].take(code), begin)
                    n += np.bincount(row, minlength=len(texts))
                ids = batch.column("doc_id").slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n_words.astype(np.int64)), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"]
                )

    return weigh


def bucket_counts(rows: DataFrame, longest: int, buckets: int) -> DataFrame:
    """``bucket, n`` over all texts of ``rows``; a row for each bucket and
    task goes through the shuffle."""
    return rows.select("text").mapInArrow(_count(longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """The gain of every bucket, at most ``buckets`` of them."""
    both = bucket_counts(docs, longest, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        bucket_counts(target, longest, buckets).select("bucket", F.lit(0).cast("long"), "n")
    )
    counts = {r["bucket"]: (r["s"], r["t"]) for r in both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()}
    s, t = (np.array([counts.get(b, (0, 0))[k] for b in range(buckets)], np.int64) for k in (0, 1))
    up = (t + 1).astype(float) * float(s.sum() + buckets)
    down = (s + 1).astype(float) * float(t.sum() + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def ranked(rows: DataFrame, by: list, name: str) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3 ... in the order ``by``, without a
    single task that sees them all."""
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id()  # the range in the upper 31 bits, the place in it in the lower 33
    placed = written(
        ordered.withColumns({"range": F.shiftright(place, 33), "place": place.bitwiseAND(F.lit((1 << 33) - 1))}), name
    )
    sizes = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # one row for each range
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    return placed.join(before, "range").withColumn("rank", F.col("before") + F.col("place") + 1).drop("range", "place", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, longest: int = 1, buckets: int = 10_000, min_words: int = 20,
             seed: int = 2024) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document;
    ``rank`` is null for those not drawn."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = rows_with_key(docs, "doc_id", "text")
    texts = target.select(F.col("text").cast("string").alias("text"))
    gains = spark.sparkContext.broadcast(bucket_gains(rows, texts, longest, buckets))
    weighed = rows.mapInArrow(_weigh(longest, buckets, gains), "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = written(weighed.withColumn("score", F.col("weight") + noise), "weights")
    able = scored.where((F.col("n_words") >= min_words) & F.col("doc_id").isNotNull())
    drawn = percent * able.count() // 100
    order = [F.desc("score"), F.asc("doc_id"), F.asc("weight"), F.asc("n_words")]
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint")
    placed = ranked(able, order, "order").withColumn("rank", rank)
    rest = scored.where((F.col("n_words") < min_words) | F.col("doc_id").isNull())
    return placed.unionByName(rest.withColumn("rank", F.lit(None).cast("bigint")))
