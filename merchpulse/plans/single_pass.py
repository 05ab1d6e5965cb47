"""Single-pass plan: every quota from one ``groupBy(merchant)``.

Each code and month of a merchant normally holds one value.  The fold takes
the largest value of each (a column of its own) and counts the rows; where
there are as many rows as months with a value, these are the values, and every
quota is an expression across the columns -- no sums over rows, no self-join
and no window, so the result cannot depend on partitioning.  Two shuffles in
all (the distinct and the merchant fold), both with map-side partial
aggregation, so a hot merchant sends one row per map task.

A merchant with more rows than that has conflicting values.  The single-pass
plan raises; ``all_quotas_hybrid`` folds the exact month totals of such
merchants, and only of them, and takes what depends on the single values
(variations, growth and the whole-number deals) from their operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchpulse.functions.numeric import add_in_order, finite
from merchpulse.operators import quotas
from merchpulse.operators.growth import growth_month_stats, growth_per_merchant
from merchpulse.operators.merge import round_quotas
from merchpulse.operators.quotas import cv_of, is_code, month_values, refund_rate_of, share_of, total_of, yoy_of
from merchpulse.operators.sums import month_totals
from merchpulse.plans.periods import Periods
from merchpulse.schema import (
    CUST_ONE_PRICE,
    DEAL_CUST_CNT,
    GROWTH_THRESHOLD,
    KEY,
    QUOTAS,
    REFUND_RATE,
    SALE_AMOUNT,
    TOP3_GOODS_REVENUE,
    TOP10_CUST_REVENUE,
)
from merchpulse.session import cut_lineage


#: Column prefix of each code in the fold; ``ye`` holds the year-earlier sales.
_CODES = {"sale": SALE_AMOUNT, "deal": DEAL_CUST_CNT, "price": CUST_ONE_PRICE, "refund": REFUND_RATE, "top3": TOP3_GOODS_REVENUE, "top10": TOP10_CUST_REVENUE}


def merchant_fold(base: DataFrame, p: Periods, n: Column | None = None) -> DataFrame:
    """One row for each merchant: its rows, how many sales values it has in
    either window (``n`` in a row), and the largest value of every code and
    month (null without one)."""
    n = F.lit(1) if n is None else n
    values = [c for prefix, code in _CODES.items() for c in month_values(code, p.months, prefix)]
    return base.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.when(is_code(SALE_AMOUNT, p.months), n)), F.lit(0)).alias("sale_n"),
        F.coalesce(F.sum(F.when(is_code(SALE_AMOUNT, p.ye_months), n)), F.lit(0)).alias("ye_n"),
        *values, *month_values(SALE_AMOUNT, p.ye_months, "ye"),
    )


def _present(prefix: str, n: int) -> Column:
    """How many months have a value."""
    total = F.lit(0)
    for i in range(n):
        total = total + F.col(f"{prefix}_{i}").isNotNull().cast("int")
    return total


def _across(fold: DataFrame, prefix: str, n: int) -> DataFrame:
    """What a coefficient of variation needs of the months' values, in steps
    of which each names the last one's columns."""
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda x, y: x + y)
    fold = fold.withColumn("vs", F.filter(F.array(*[F.col(f"{prefix}_{i}") for i in range(n)]), lambda x: x.isNotNull()))
    fold = fold.withColumn("mean", add(F.col("vs")) / F.nullif(F.size("vs"), F.lit(0)))
    fold = fold.withColumn("vs", F.transform("vs", lambda x: x - F.col("mean")))
    cv = cv_of(F.size("vs"), F.col("mean"), add(F.col("vs")), add(F.transform("vs", lambda x: x * x)))
    return fold.withColumn(f"{prefix}_cv", F.when(F.size("vs") >= 2, cv)).drop("vs", "mean")


def quotas_from_fold(fold: DataFrame, p: Periods, threshold: float = GROWTH_THRESHOLD) -> DataFrame:
    n = p.n
    counts = {f"{prefix}_months": _present(prefix, n) for prefix in [*_CODES, "ye"]}
    fold = fold.withColumns(counts)
    fold = _across(_across(fold, "sale", n), "price", n)
    values = add_in_order([F.col(c) for c in counts])
    has_sales = F.col("sale_n") > 0
    q = {}
    q["avg_sale_amount"] = F.when(has_sales, finite(total_of("sale", n) / F.lit(float(n))))
    deals = F.lit(0).cast("bigint")
    for i in range(n):
        deals = deals + F.coalesce(F.col(f"deal_{i}").cast("bigint"), F.lit(0))
    q["avg_deal_cnt"] = F.when(F.col("deal_months") > 0, F.call_function("div", deals, F.lit(n)))
    q["refund_rate"] = F.when(has_sales & (F.col("refund_months") > 0), refund_rate_of(p))
    q["sale_amount_cv"] = F.col("sale_cv")
    q["cust_price_cv"] = F.col("price_cv")
    for name, pre in (("top3_goods_share", "top3"), ("top10_cust_share", "top10")):
        q[name] = F.when(has_sales & (F.col(f"{pre}_months") > 0), share_of(pre, p))
    q["yoy_growth_rate"] = F.when(has_sales & (F.col("ye_n") > 0), yoy_of(p))
    pairs, up, ratios = F.lit(0), F.lit(0), []
    for i in range(1, n):
        a, b = F.col(f"sale_{i}"), F.col(f"sale_{i - 1}")
        r = F.when(a.isNotNull() & (b != 0), a / b)
        ratios.append(r)
        pairs = pairs + r.isNotNull().cast("int")
        up = up + F.coalesce(r >= F.lit(threshold), F.lit(False)).cast("int")
    q["growth_multiple"] = F.when(pairs > 0, finite(add_in_order(ratios) / pairs.cast("double") * F.lit(100.0)))
    q["increase_month_num"] = F.when(pairs > 0, up.cast("int"))
    cols = [F.col(KEY)] + [q[name].alias(name) for name in QUOTAS]
    return fold.select(*cols, (F.col("rows") > values).alias("_conflict"))


def _any_defined(names):
    defined = None
    for name in names:
        c = F.col(name).isNotNull()
        defined = c if defined is None else defined | c
    return defined


def all_quotas(base: DataFrame, p: Periods) -> DataFrame:
    """Q12 by the single-pass plan."""
    fold = merchant_fold(base, p)
    out = quotas_from_fold(fold, p)
    guard = F.when(
        F.col("_conflict"),
        F.raise_error(F.concat(F.lit("single_pass needs one sales value per month, and one of each other code; merchant "), F.col(KEY))),
    )
    # the guard is part of the filter, so it cannot be pruned away
    out = out.where(guard.isNull()).drop("_conflict")
    return round_quotas(out.where(_any_defined(QUOTAS)))


def _conflicting(base: DataFrame, p: Periods) -> DataFrame:
    """The quotas of merchants with conflicting values, one row each."""
    folded = quotas_from_fold(merchant_fold(month_totals(base), p, F.col("n")), p)
    of_values = growth_per_merchant(growth_month_stats(base, p)).join(quotas.variations(base, p), KEY, "full").join(quotas.avg_deal_cnt(base, p), KEY, "full")
    kept = [q for q in QUOTAS if q not in of_values.columns]
    return folded.select(KEY, *kept).join(of_values, KEY, "left").select(KEY, *QUOTAS).where(_any_defined(QUOTAS))


def all_quotas_hybrid(base: DataFrame, p: Periods) -> DataFrame:
    """Q12, exact for any input.

    The merchant fold for all merchants, then month totals and the operators
    over single values for those with conflicts.  The fold (one row per
    merchant) is checkpointed, so checking whether any merchant needs that --
    normally none does -- costs a scan of it, and the other jobs run only when
    needed.  The merchant list is a semi-join's small side, which AQE
    broadcasts only if its measured size allows.  ``base`` is read once, by the
    fold; only when some merchant has conflicts are the rows of such merchants
    read again and checkpointed.
    """
    fold_q = cut_lineage(quotas_from_fold(merchant_fold(base, p), p))
    conflicted = fold_q.where(F.col("_conflict")).select(KEY)
    out = fold_q.where(~F.col("_conflict")).select(KEY, *QUOTAS).where(_any_defined(QUOTAS))
    if not conflicted.isEmpty():
        subset = cut_lineage(base.join(conflicted, KEY, "left_semi"))
        out = out.unionByName(_conflicting(subset, p))
    return round_quotas(out)
