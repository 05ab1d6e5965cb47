"""Month-on-month growth.

A growth pair is a sales value ``a`` of month ``m`` and a value ``b`` of
month ``m-1``, both in the window; its ratio is ``a / b``.  Normally each
month holds one value, but conflicting values are kept (P4), and then
every value of ``m`` pairs with every value of ``m-1``.
``growth_pair_rows`` returns the pairs themselves.  The two quotas need no
pairs; there each ``(merchant, m)`` is solved as counting:

* pair count = ``count(a) * count(b != 0)``; ratio sum = ``sum over b of
  count(a) * (mean a / b)``, from exact sums, so that neither depends on how
  rows were partitioned and no intermediate sum overflows;
* ratios ``>= 1.1`` for a divisor ``b``: ``a / b`` is monotone in ``a``, so
  the qualifying ``a`` are those at or above (``b > 0``) or at or below
  (``b < 0``) one threshold.  The threshold is found exactly by bisecting the
  ordered doubles around ``1.1 * b`` (it lies within three units in the last
  place of it), for every finite ``b``: subnormal ones have neighbours one
  smallest double apart, and beyond the largest double the threshold is
  infinite, which no ``a`` reaches.  What remains is a rank query.

The rank query is distributed: values and thresholds are range-partitioned
on ``(merchant, m, value)`` -- Spark samples the bounds, so one hot
``(merchant, m)`` spreads over many partitions -- each range counts
locally with a window, and a small per-range table adds the counts of the
ranges before it.  No group is ever gathered in one task.

A pair whose divisor is 0 has no ratio and is left out of mean and count; a
merchant with a ratio beyond the range of doubles has no mean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchpulse.functions.exact import LARGEST, SMALLEST, before, bound, value_of
from merchpulse.functions.numeric import finite
from merchpulse.operators.sums import exact_sums
from merchpulse.plans.periods import Periods, next_month
from merchpulse.schema import CODE, GROWTH_THRESHOLD, KEY, MONTH, SALE_AMOUNT
from merchpulse.session import cut_lineage

# half steps searched either way of 1.1 * b: four units in the last place
_HALVES = 8
#: Values of a merchant's month in one block of the pair join.
PAIR_BLOCK = 1024
#: Shares into which the values of a month of several blocks are dealt.
_SALT = 64


def _next_month_expr(months: tuple[str, ...]):
    mapping = []
    for m in months:
        mapping += [F.lit(m), F.lit(next_month(m))]
    return F.create_map(*mapping)[F.col(MONTH)]


def exact_threshold(b: Column, threshold: float) -> Column:
    """For ``b > 0`` the smallest double ``a`` with ``a / b >= threshold``;
    for ``b < 0`` the largest; infinite where no double is."""
    if not threshold > 0:
        raise ValueError("the growth threshold must be above 0")
    size = F.abs(b)

    def search(t: Column, half: Column, low: int, high: int) -> Column:
        """The lowest candidate that qualifies among ``low .. high``."""
        if low == high:
            return t + F.lit(float(low)) * half if low <= _HALVES else F.lit(float("inf"))
        middle = (low + high) // 2
        enough = (t + F.lit(float(middle)) * half) / size >= F.lit(threshold)
        return F.when(enough, search(t, half, low, middle)).otherwise(search(t, half, middle + 1, high))

    def found(t: Column) -> Column:
        # half the distance to the neighbour below reaches every double on either
        # side of a power of two; the subnormal doubles lie evenly
        half = F.greatest((t - before(t)) * F.lit(0.5), F.lit(SMALLEST))
        return bound(half, lambda h: search(t, h, -_HALVES, _HALVES + 1))

    lowest = bound(F.least(size * F.lit(threshold), F.lit(LARGEST)), found)
    return F.when(b > 0, lowest).otherwise(-lowest)


def window_sales(base: DataFrame, p: Periods) -> DataFrame:
    return base.where((F.col(CODE) == SALE_AMOUNT) & F.col(MONTH).between(p.start, p.end))


def _blocked(values: DataFrame, mine: str, other: str, sizes: DataFrame, salt: int) -> DataFrame:
    """Values of a side, each in one block of its own (``mine``) and copied to
    every block of the other side (``other``); months of one block, which is
    nearly all, are not in ``sizes`` and stay as they are."""
    salted = values.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salt)).cast("int"))
    joined = salted.join(sizes, [KEY, "m", "salt"], "left")
    own, rest = F.coalesce(F.col(f"{mine}_blocks"), F.lit(1)), F.coalesce(F.col(f"{other}_blocks"), F.lit(1))
    return joined.select(
        KEY, "m", F.col("v").alias(mine), F.pmod(F.xxhash64("v", F.lit(mine)), own.cast("bigint")).cast("int").alias(f"{mine}_block"),
        F.explode(F.sequence(F.lit(0), rest - 1)).alias(f"{other}_block"),
    )


def growth_pair_rows(base: DataFrame, p: Periods, block: int = PAIR_BLOCK) -> DataFrame:
    """Every growth pair as ``(key, month, a, b, ratio)``.

    An equi-join on merchant and month.  A month with more than ``block``
    values is cut into blocks, and its pairs are made by pairs of blocks: no
    join group holds more than about ``block`` values of either side, so a
    hot month's pairs are made by as many tasks as it has pairs of blocks.
    How many blocks a month has is joined on by shares of its values.
    """
    sales = window_sales(base, p)
    later = sales.where(F.col(MONTH).isin(list(p.months[1:]))).select(KEY, F.col(MONTH).alias("m"), F.col("value").alias("v"))
    earlier = sales.where(F.col(MONTH).isin(list(p.months[:-1])) & (F.col("value") != 0)).select(
        KEY, _next_month_expr(p.months[:-1]).alias("m"), F.col("value").alias("v")
    )
    counted = later.select(KEY, "m", F.lit(1).alias("is_a")).unionByName(earlier.select(KEY, "m", F.lit(0).alias("is_a")))
    blocks = lambda side: F.ceil(F.count_if(F.col("is_a") == side) / F.lit(block)).cast("int")
    sizes = (
        counted.groupBy(KEY, "m").agg(F.greatest(blocks(1), F.lit(1)).alias("a_blocks"), F.greatest(blocks(0), F.lit(1)).alias("b_blocks"))
        .where("a_blocks > 1 or b_blocks > 1")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALT - 1))))
    )
    left, right = _blocked(later, "a", "b", sizes, _SALT), _blocked(earlier, "b", "a", sizes, _SALT)
    pairs = left.join(right, [KEY, "m", "a_block", "b_block"])
    return pairs.select(KEY, F.col("m").alias(MONTH), "a", "b", (F.col("a") / F.col("b")).alias("ratio"))


def growth_month_stats(base: DataFrame, p: Periods, threshold: float = GROWTH_THRESHOLD) -> DataFrame:
    """Per ``(merchant, m)`` with values in both ``m`` and ``m-1``:
    ``pairs`` (ratios with a non-zero divisor), ``ratio_sum`` and ``up``
    (ratios ``>= threshold``).

    The range partitioner samples its input in a separate pass, so give
    this a materialised ``base`` (the plans do).  Runs one checkpoint job
    when called.
    """
    sales = window_sales(base, p)
    # A rows sort between the two kinds of probe at an equal key:
    # b > 0 probes (tb 0) count A strictly below, b < 0 probes (tb 2) A at or below
    later = sales.where(F.col(MONTH).isin(list(p.months[1:]))).select(
        KEY,
        F.col(MONTH).alias("m"),
        F.col("value").alias("sort_key"),
        F.lit(1).alias("tb"),
        F.lit(1).alias("is_a"),
        F.lit(None).cast("double").alias("b"),
    )
    b = F.col("value")
    earlier = sales.where(F.col(MONTH).isin(list(p.months[:-1])) & (b != 0)).select(
        KEY,
        _next_month_expr(p.months[:-1]).alias("m"),
        exact_threshold(b, threshold).alias("sort_key"),
        F.when(b > 0, F.lit(0)).otherwise(F.lit(2)).alias("tb"),
        F.lit(0).alias("is_a"),
        b.alias("b"),
    )
    ranged = (
        later.unionByName(earlier)
        .repartitionByRange(KEY, "m", "sort_key", "tb")
        .withColumn("part", F.spark_partition_id())
    )
    # Local ranks, then one materialisation: the range bounds come from a
    # sampling pass seeded per run, so the two uses below must read the same
    # computed ranges rather than each re-running the range shuffle.
    local = Window.partitionBy(KEY, "m", "part").orderBy("sort_key", "tb")
    ranked = cut_lineage(ranged.withColumn("a_local", F.sum("is_a").over(local)))
    parts = ranked.groupBy(KEY, "m", "part").agg(F.sum("is_a").alias("n_part"))
    earlier_parts = Window.partitionBy(KEY, "m").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("a_before", F.coalesce(F.sum("n_part").over(earlier_parts), F.lit(0)))
    means = exact_sums(ranked.where(F.col("is_a") == 1), [KEY, "m"], {"total": [F.col("sort_key")]}).select(
        KEY, "m", F.col("n").alias("n_a"), value_of(F.col("total"), F.col("n").cast("double")).alias("mean_a")
    )
    # a row for each range of a month, so that the ranges' probes find both in one join
    known = parts.join(means, [KEY, "m"]).drop("n_part")
    probes = ranked.where(F.col("is_a") == 0).join(known, [KEY, "m", "part"])
    below = F.col("a_before") + F.col("a_local")
    up = F.when(F.col("b") > 0, F.col("n_a") - below).otherwise(below)
    counted = probes.select(KEY, "m", "n_a", up.alias("up"), (F.col("n_a").cast("double") * (F.col("mean_a") / F.col("b"))).alias("ratios"))
    ratios = exact_sums(counted, [KEY, "m"], {"ratios": [F.col("ratios")]}).select(KEY, "m", value_of(F.col("ratios")).alias("ratio_sum"))
    counts = counted.groupBy(KEY, "m").agg(F.sum("n_a").cast("bigint").alias("pairs"), F.sum("up").cast("bigint").alias("up"))
    return counts.join(ratios, [KEY, "m"]).select(KEY, "m", "pairs", "ratio_sum", "up")


def growth_per_merchant(month_stats: DataFrame) -> DataFrame:
    """Q9 and Q10 from the per-month pair statistics.

    A merchant has at most window-length - 1 pair months, so the months are
    gathered per merchant (a bounded list) and summed in month order, which
    keeps the double sum independent of shuffle order.
    """
    arr = F.array_sort(F.collect_list(F.struct("m", "pairs", "ratio_sum", "up")))
    g = month_stats.groupBy(KEY).agg(arr.alias("months"))
    pairs = F.aggregate("months", F.lit(0).cast("bigint"), lambda acc, x: acc + x["pairs"])
    ratio = F.aggregate("months", F.lit(0.0), lambda acc, x: acc + x["ratio_sum"])
    up = F.aggregate("months", F.lit(0).cast("bigint"), lambda acc, x: acc + x["up"])
    return (
        g.select(KEY, pairs.alias("pairs"), ratio.alias("ratio"), up.alias("up"))
        .where(F.col("pairs") > 0)
        .select(
            KEY,
            finite(F.col("ratio") / F.col("pairs").cast("double") * F.lit(100.0)).alias("growth_multiple"),
            # the quota is an int; more rising pairs than it holds count as its largest value
            F.least(F.col("up"), F.lit(2**31 - 1)).cast("int").alias("increase_month_num"),
        )
    )


def growth_multiple(base: DataFrame, p: Periods) -> DataFrame:
    """Q9: mean month-on-month ratio * 100."""
    return growth_per_merchant(growth_month_stats(base, p)).select(KEY, "growth_multiple")


def increase_month_num(base: DataFrame, p: Periods) -> DataFrame:
    """Q10: number of month-on-month ratios >= 1.1 (0 if pairs exist but none
    qualify, absent if there is no pair)."""
    return growth_per_merchant(growth_month_stats(base, p)).select(KEY, "increase_month_num")
