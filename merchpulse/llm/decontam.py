"""Benchmark decontamination with suffix arrays of the training texts.

Each shard of training texts (a few MB of whole texts) gets a suffix array
over its words; every suffix of the benchmark is binary-searched in it, which
gives the range of training suffixes that share its first ``WINDOW`` words,
and each of those places is extended to the longest verbatim match.  Only
benchmark words can match, so all others are breaks in the shard's array.

The benchmark is sent to the shards in blocks of at most ``BLOCK_BYTES`` of
text, each block against all documents; nothing is shuffled unless there is
more than one block.

Words are the runs ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased.  A window is ``WINDOW`` consecutive words of an item; an item
with fewer words, but not none, is one window.

Defined cases: null and empty texts have no words and match nothing; items
without an id are left out; repeated documents give repeated results and
repeated items count once by id; documents without an id are judged like
others; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchpulse.llm.tables import rows_with_key, ship_package, text_slices
from merchpulse.llm.textbytes import ALNUM, split_words

WINDOW = 10
SLICE_BYTES = 4 << 20
#: Benchmark text sent to the executors at once.
BLOCK_BYTES = 4 << 20

SPAN = "struct<start:int,end:int>"
MATCH = "struct<item_id:string,item_start:int,doc_start:int,n_words:int>"
SCHEMA = f"doc_id long, text_hash long, n_words long, spans array<{SPAN}>, items array<string>, matches array<{MATCH}>"


class Benchmark:
    """One block of items as word numbers (1 and up), with its windows."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        words = split_words([text for _, text in items], ALNUM)
        self.vocabulary, numbers = np.unique(words.hashes(), return_inverse=True)
        count = np.diff(words.first)
        self.window = window
        # the items one after another, each followed by a break
        self.words = np.zeros(len(numbers) + len(items) + window, np.int64)
        item_of_word = np.repeat(np.arange(len(items)), count)
        self.item_start = words.first[:-1] + np.arange(len(items))
        self.words[np.arange(len(numbers)) + item_of_word] = numbers + 1
        starts, lengths, owner = [], [], []
        for i, n in enumerate(count):
            for j in range(max(n - window, 0) + 1 if n else 0):
                starts.append(self.item_start[i] + j)
                lengths.append(min(window, n))
                owner.append(i)
        self.starts, self.lengths, self.owner = (np.array(x, np.int64) for x in (starts, lengths, owner))
        # different windows; by_window lists the places of each
        rows = self.words[self.starts[:, None] + np.arange(window)] if len(starts) else np.zeros((0, window), np.int64)
        rows = np.where(np.arange(window) < self.lengths[:, None], rows, 0) if len(starts) else rows
        self.windows, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        self.by_window = np.argsort(which.ravel(), kind="stable")
        self.window_first = np.searchsorted(which.ravel()[self.by_window], np.arange(len(self.windows) + 1))
        self.window_length = (self.windows > 0).sum(axis=1)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``words`` above 0 in the order of their next ``depth`` words
    at least (0 sorts first), by prefix doubling."""
    places = np.flatnonzero(words)
    rank = np.concatenate([words, np.zeros(2 * depth + 1, np.int64)])
    order, h = np.arange(len(places)), 1
    while True:
        key = rank[places] * (int(rank.max(initial=0)) + 1) + rank[places + h]
        order = np.argsort(key)
        key = key[order]
        new = np.zeros(len(rank), np.int64)
        step = np.ones(len(key), np.int64)
        step[1:] = key[1:] != key[:-1]
        new[places[order]] = np.cumsum(step)
        rank, h = new, 2 * h
        if h >= depth or not len(places) or step.all():
            return places[order]


def suffix_ranges(words: np.ndarray, suffixes: np.ndarray, b: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the benchmark, its range in the suffix array."""
    padded = np.concatenate([words, np.zeros(b.window, np.int64)])
    column = np.arange(b.window)
    cared = column < b.window_length[:, None]

    def bound(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(b.windows), np.int64), np.full(len(b.windows), len(suffixes))
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            diff = np.where(cared[open_], padded[suffixes[mid][:, None] + column] - b.windows[open_], 0)
            at = (diff != 0).argmax(axis=1)
            sign = diff[np.arange(len(open_)), at]
            before = sign <= 0 if upper else sign < 0
            lo[open_] = np.where(before, mid + 1, lo[open_])
            hi[open_] = np.where(before, hi[open_], mid)
        return lo

    return bound(False), bound(True)


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every index of the ranges, and which range it is of."""
    size = hi - lo
    which = np.repeat(np.arange(len(lo)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size), which


def find_matches(texts: list[bytes], b: Benchmark):
    """Words by text, and the hits of the block: places (text, word), and the
    maximal verbatim matches (place, benchmark place, words, owner)."""
    found = split_words(texts, ALNUM)
    n = len(texts)
    hashes = found.hashes()
    number = np.searchsorted(b.vocabulary, hashes)
    known = number < len(b.vocabulary)
    known[known] = b.vocabulary[number[known]] == hashes[known]
    text_of = np.repeat(np.arange(n), np.diff(found.first))
    words = np.zeros(len(hashes) + n + 1, np.int64)  # a break after each text
    words[np.arange(len(hashes)) + text_of] = np.where(known, number + 1, 0)
    base = found.first[:-1] + np.arange(n)
    suffixes = suffix_array(words, b.window)
    lo, hi = suffix_ranges(words, suffixes, b) if len(b.windows) else (np.zeros(0, np.int64),) * 2
    at, window = _expand(lo, hi)
    place = suffixes[at]
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, place, 1)
    np.add.at(covered, place + b.window_length[window], -1)
    covered = np.cumsum(covered)[:-1] > 0
    # each place with each benchmark place of its window
    pair, which = _expand(b.window_first[window], b.window_first[window + 1])
    here, source = place[which], b.by_window[pair]
    there = b.starts[source]
    padded, bench = np.concatenate([words, [0]]), np.concatenate([b.words, [0]])
    before = (here > 0) & (there > 0) & (words[here - 1] > 0) & (words[here - 1] == b.words[there - 1])
    here, there, source = here[~before], there[~before], source[~before]  # only where a match begins
    length = b.lengths[source].copy()
    going = np.arange(len(here))
    while going.size:
        a, c = padded[np.minimum(here[going] + length[going], len(words))], bench[np.minimum(there[going] + length[going], len(b.words))]
        going = going[(a == c) & (a > 0)]
        length[going] += 1
    return np.diff(found.first), base, covered, here, there, length, b.owner[source]


def _judge(sent):
    def judge(batches):
        b = Benchmark(sent.value)
        for rows, texts in text_slices(batches, SLICE_BYTES):
            n_words, base, covered, here, there, length, owner = find_matches(texts, b)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
            s, e = edges[0::2], edges[1::2]
            span_of = np.searchsorted(base, s, side="right") - 1
            spans = [[] for _ in texts]
            for t, x, y in zip(span_of, s, e):
                spans[t].append({"start": int(x - base[t]), "end": int(y - base[t])})
            matches, items = [[] for _ in texts], [set() for _ in texts]
            match_of = np.searchsorted(base, here, side="right") - 1
            for t, x, y, size, i in zip(match_of, here, there, length, owner):
                items[t].add(b.names[i])
                matches[t].append({"item_id": b.names[i], "item_start": int(y - b.item_start[i]), "doc_start": int(x - base[t]), "n_words": int(size)})
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": rows.column("doc_id"), "text_hash": rows.column("text_hash"), "n_words": pa.array(n_words, pa.int64()),
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    "matches": pa.array(matches, pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())]))),
                }
            )

    return judge


def _blocks(benchmark: DataFrame, limit: int):
    block, size = [], 0
    items = rows_with_key(benchmark, "item_id", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    for r in items.toLocalIterator():
        text = r["text"].encode()
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((str(r["item_id"]), text))
        size += len(text)
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, items, matches`` of every document: words
    inside windows, ids of the items they are of, and the maximal verbatim
    matches with their places (in words)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = rows_with_key(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    parts = [rows.mapInArrow(_judge(spark.sparkContext.broadcast(b)), SCHEMA) for b in _blocks(benchmark, block_bytes)]
    if not parts:
        parts = [rows.mapInArrow(_judge(spark.sparkContext.broadcast([])), SCHEMA)]
    found = parts[0]
    if len(parts) > 1:
        every = parts[0].withColumn("copies", F.lit(1))
        for p in parts[1:]:
            every = every.union(p.withColumn("copies", F.lit(0)))
        found = (
            every.groupBy("doc_id", "text_hash")
            .agg(
                F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
                F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                F.array_distinct(F.flatten(F.collect_list("matches"))).alias("matches"), F.sum("copies").alias("copies"),
            )
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        )
    hit = F.expr(
        "aggregate(array_sort(spans), struct(0 as reach, 0L as n), (a, x) -> struct("
        "greatest(a.reach, x.end) as reach, a.n + greatest(x.end - greatest(a.reach, x.start), 0) as n), a -> a.n)"
    )
    return found.select("doc_id", "n_words", hit.cast("long").alias("n_hit"), F.array_sort("items").alias("items"), F.array_sort("matches").alias("matches"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    hit = contamination(docs, benchmark).where(F.col("n_hit") > 0).select("doc_id")
    clean = docs.join(hit.where(F.col("doc_id").isNotNull()).distinct(), "doc_id", "left_anti")
    return clean.select(*docs.columns)
