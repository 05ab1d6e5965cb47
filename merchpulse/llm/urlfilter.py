"""URL filter: a blocked Bloom filter of listed (host, path) rules passes
possible hits to an exact hash join that removes false positives.

Everything is DataFrame functions.  A rule ``(host, path, verdict)`` fits a
URL whose host is the rule's host or a subdomain of it and whose path starts
with the rule's path; the longest rule (host and path together, then the
longer host) decides, and a URL without a rule is allowed.

Defined cases: a null URL, or one without ``://``, has an empty host and
path, no rule and the verdict ``allow``; repeated rows give repeated results;
a rule with a null or empty host never fits; rules repeated with the same
host and path count once, ``block`` before ``allow``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bits for each rule, and the largest filter: 2**15 blocks of 256 bits are
#: 1 MiB.  A longer list makes the filter fuller, never the result wrong.
BITS_PER_RULE = 16
MAX_BLOCKS = 1 << 15
WORDS = 4  # 64-bit words of a block; each gets two bits of a key


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path by position: after the first ``://`` up to ``/?#``, then
    up to ``?#``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def _masks(h: Column) -> list[Column]:
    """Two bits in each of the block's words, from six hash bits each."""
    def bit(i: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]


def _hash(host: Column, path: Column) -> Column:
    return F.xxhash64(host, F.lit("\x00"), path)


def _block(host: Column, path: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(path, F.lit("\x01"), host), F.lit(blocks)).cast("int")


def bloom_filter(rules: DataFrame, blocks: int) -> DataFrame:
    """The filter as a table: a row of four 64-bit words for each block that
    has bits; at most ``blocks`` rows."""
    h = _hash(F.col("host"), F.col("path"))
    words = rules.select(
        _block(F.col("host"), F.col("path"), blocks).alias("block"),
        *[m.alias(f"w{i}") for i, m in enumerate(_masks(h))],
    )
    return words.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def candidate_keys(urls: DataFrame, path_lengths: list[int]) -> DataFrame:
    """Every (host suffix, path prefix) that a rule could be listed under, for
    the path lengths that the rules have."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))),
    )
    lengths = F.filter(F.lit(path_lengths).cast("array<int>"), lambda n: n <= F.length("path"))
    return (
        urls.where(F.col("host") != "")
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("n", F.explode(lengths))
        .select("host", "path", "suffix", F.expr("substring(path, 1, n)").alias("prefix"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    Different (host, path) values are judged once.  The lengths of the rules'
    paths are at most ``MAX_PATH`` numbers; the filter has at most
    ``MAX_BLOCKS`` rows, the bound by which it is broadcast.
    """
    rules = (
        rules.select(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .where((F.col("host") != "") & F.col("verdict").isin("allow", "block"))
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    )
    n_rules, longest = rules.agg(F.count(F.lit(1)), F.max(F.length("path"))).first()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 64 * WORDS < n_rules * BITS_PER_RULE:
        blocks *= 2
    if (longest or 0) > MAX_PATH:
        raise ValueError(f"a rule's path is longer than {MAX_PATH}")
    host, path = url_parts(F.col(url))
    judged = pages.withColumns({"host": host, "path": path})
    keys = judged.select("host", "path").distinct()
    lengths = sorted(r["n"] for r in rules.select(F.length("path").alias("n")).distinct().collect())
    candidates = candidate_keys(keys, lengths)
    f = bloom_filter(rules, blocks)
    passes = F.col("c.block") == F.col("f.block")
    for i, m in enumerate(_masks(_hash(F.col("c.suffix"), F.col("c.prefix")))):
        passes = passes & (F.col(f"f.w{i}").bitwiseAND(m) == m)
    possible = (
        candidates.withColumn("block", _block(F.col("suffix"), F.col("prefix"), blocks)).alias("c")
        .join(F.broadcast(f).alias("f"), passes)
        .select("c.host", "c.path", "c.suffix", "c.prefix")
    )
    listed = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict")
    best = (
        possible.join(listed, ["suffix", "prefix"])
        .groupBy("host", "path")
        .agg(F.max(F.struct(
            (F.length("suffix") + F.length("prefix")).alias("size"), F.length("suffix").alias("host_size"),
            F.concat("suffix", "prefix").alias("rule"), "verdict",
        )).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    return judged.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit("allow")))


#: Rules with longer paths are refused, which bounds the table of lengths.
MAX_PATH = 2048
