"""The quotas (Q1-Q8), one operator each, over the distinct base values.

Every operator takes the frame from ``slices.base_values`` -- columns
``(property_uuid, target_time, metric_dim_code, value)`` -- and the
analysis periods, and returns ``(property_uuid, <quota>)`` for the
merchants where the quota is defined.  Values are raw (not rounded); the
merge rounds them.  The values of a month are summed exactly and rounded once
(``sums.month_totals``, which several quotas can share), then the months are
added in order, so a result depends on the values alone and never on how they
were partitioned.  Coefficients of variation come from exact sums too.  A zero
divisor, or a result beyond the range of doubles, makes the quota absent
(null, then dropped) instead of failing the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchpulse.functions.exact import bound, square_halves, value_of
from merchpulse.functions.numeric import add_in_order, finite, safe_div
from merchpulse.operators.sums import exact_sums, month_totals
from merchpulse.plans.periods import Periods
from merchpulse.schema import (
    CODE,
    CUST_ONE_PRICE,
    DEAL_CUST_CNT,
    KEY,
    MONTH,
    REFUND_RATE,
    SALE_AMOUNT,
    TOP3_GOODS_REVENUE,
    TOP10_CUST_REVENUE,
)


def code_slice(base: DataFrame, code: str, p: Periods, year_earlier: bool = False) -> DataFrame:
    """``(key, month, value)`` of one code in the window (or the year-earlier
    window)."""
    lo, hi = (p.ye_start, p.ye_end) if year_earlier else (p.start, p.end)
    return base.where((F.col(CODE) == code) & F.col(MONTH).between(lo, hi)).select(KEY, MONTH, "value")


def is_code(code: str, months) -> Column:
    """Rows of one code in some months."""
    return (F.col(CODE) == code) & F.col(MONTH).isin(list(months))


def month_values(code: str, months, prefix: str) -> list[Column]:
    """Aggregates over one value for each month and code: the code's value in
    each month (null without one)."""
    return [F.max(F.when(is_code(code, [m]), F.col("value"))).alias(f"{prefix}_{i}") for i, m in enumerate(months)]


def total_of(prefix: str, n: int) -> Column:
    return add_in_order([F.col(f"{prefix}_{i}") for i in range(n)])


def count_of(code: str, months) -> Column:
    """Aggregate over month totals: how many values the code has."""
    return F.coalesce(F.sum(F.when(is_code(code, months), F.col("n"))), F.lit(0))


def _by_merchant(base: DataFrame, totals: DataFrame | None, wanted: Column, *aggs: Column) -> DataFrame:
    """The aggregates by merchant over the month totals of some rows."""
    rows = month_totals(base.where(wanted)) if totals is None else totals.where(wanted)
    return rows.groupBy(KEY).agg(*aggs)


def _defined(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNotNull())


def avg_sale_amount(base: DataFrame, p: Periods, totals: DataFrame | None = None) -> DataFrame:
    """Q1: total sales / n, where n is the window length even when months
    are missing."""
    sums = _by_merchant(base, totals, is_code(SALE_AMOUNT, p.months), *month_values(SALE_AMOUNT, p.months, "sale"))
    out = sums.select(KEY, finite(total_of("sale", p.n) / F.lit(float(p.n))).alias("avg_sale_amount"))
    return _defined(out, "avg_sale_amount")


def avg_deal_cnt(base: DataFrame, p: Periods) -> DataFrame:
    """Q2: total deals div n (integer division, bigint sum)."""
    return (
        code_slice(base, DEAL_CUST_CNT, p)
        .groupBy(KEY)
        .agg(F.sum(F.col("value").cast("bigint")).alias("deals"))
        .select(KEY, F.expr(f"deals div {int(p.n)}").alias("avg_deal_cnt"))
    )


def refund_rate_of(p: Periods, refund: str = "refund", sale: str = "sale") -> Column:
    """Q3 from month sums: sum(r(m) * a(m)) * 0.01 / sum(a) * 100.

    A refund month without sales counts 0 (J2); several values in one month
    multiply out, so the month's pair sum is sum(r) * sum(a).
    """
    pairs = add_in_order([F.col(f"{refund}_{i}") * F.col(f"{sale}_{i}") for i in range(p.n)])
    return finite(safe_div(pairs * F.lit(0.01), total_of(sale, p.n)) * F.lit(100.0))


def refund_rate(base: DataFrame, p: Periods, totals: DataFrame | None = None) -> DataFrame:
    """Q3: needs a refund month and a sales total other than zero."""
    sums = _by_merchant(
        base, totals, is_code(SALE_AMOUNT, p.months) | is_code(REFUND_RATE, p.months),
        count_of(SALE_AMOUNT, p.months).alias("sale_n"), count_of(REFUND_RATE, p.months).alias("refund_n"),
        *month_values(SALE_AMOUNT, p.months, "sale"), *month_values(REFUND_RATE, p.months, "refund"),
    )
    out = sums.where("sale_n > 0 and refund_n > 0").select(KEY, refund_rate_of(p).alias("refund_rate"))
    return _defined(out, "refund_rate")


def variation_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, cv)``: sample standard deviation / mean * 100 of ``value``, for
    two values or more (P9) and a mean other than zero.

    The mean comes from the exact sum; the squares of what the values differ
    from it are summed exactly as a rounded product and its error, so that a
    large constant costs no digits.  Values meet their mean in a join, which
    Spark splits where one merchant is hot.
    """
    means = exact_sums(df, keys, {"total": [F.col("value")]}).where("n >= 2").select(
        *keys, value_of(F.col("total"), F.col("n").cast("double")).alias("mean")
    )
    off = df.join(means, keys).select(*keys, "mean", (F.col("value") - F.col("mean")).alias("off"))
    sums = exact_sums(off, [*keys, "mean"], {"off": [F.col("off")], "squares": list(square_halves(F.col("off")))})
    stats = sums.select(*keys, "mean", "n", value_of(F.col("off")).alias("rest"), value_of(F.col("squares")).alias("squares"))
    return _defined(stats.select(*keys, cv_of(*(F.col(c) for c in ("n", "mean", "rest", "squares"))).alias("cv")), "cv")


def coefficient_of_variation(df: DataFrame, name: str) -> DataFrame:
    """Q4/Q5 over any ``(key, month, value)`` slice."""
    return variation_by(df, [KEY]).withColumnRenamed("cv", name)


def variations(base: DataFrame, p: Periods) -> DataFrame:
    """Q4 and Q5 together, from one pass over the values of both codes."""
    codes = {"sale_amount_cv": SALE_AMOUNT, "cust_price_cv": CUST_ONE_PRICE}
    rows = base.where(is_code(SALE_AMOUNT, p.months) | is_code(CUST_ONE_PRICE, p.months))
    found = variation_by(rows, [KEY, CODE])
    return found.groupBy(KEY).agg(*[F.max(F.when(F.col(CODE) == code, F.col("cv"))).alias(name) for name, code in codes.items()])


def cv_of(n: Column, mean: Column, rest: Column, squares: Column) -> Column:
    """From the sum of squares of what the values differ from the mean, and
    ``rest``, the sum of these differences: what the mean's rounding leaves."""
    variance = (squares - rest * rest / n) / (n - F.lit(1.0))
    return bound(F.sqrt(F.greatest(variance, F.lit(0.0))) / F.when(mean != 0, mean) * F.lit(100.0), finite)


def sale_amount_cv(base: DataFrame, p: Periods) -> DataFrame:
    return coefficient_of_variation(code_slice(base, SALE_AMOUNT, p), "sale_amount_cv")


def cust_price_cv(base: DataFrame, p: Periods) -> DataFrame:
    return coefficient_of_variation(code_slice(base, CUST_ONE_PRICE, p), "cust_price_cv")


def share_of(top: str, p: Periods, sale: str = "sale") -> Column:
    return finite(safe_div(total_of(top, p.n), total_of(sale, p.n)) * F.lit(100.0))


def top_share(base: DataFrame, p: Periods, code: str, name: str, totals: DataFrame | None = None) -> DataFrame:
    """Q6/Q7: sum of the pre-computed top-N revenue / total sales * 100,
    for merchants with sales (J5)."""
    sums = _by_merchant(
        base, totals, is_code(SALE_AMOUNT, p.months) | is_code(code, p.months),
        count_of(SALE_AMOUNT, p.months).alias("sale_n"), count_of(code, p.months).alias("top_n"),
        *month_values(SALE_AMOUNT, p.months, "sale"), *month_values(code, p.months, "top"),
    )
    return _defined(sums.where("sale_n > 0 and top_n > 0").select(KEY, share_of("top", p).alias(name)), name)


def top3_goods_share(base: DataFrame, p: Periods, totals: DataFrame | None = None) -> DataFrame:
    return top_share(base, p, TOP3_GOODS_REVENUE, "top3_goods_share", totals)


def top10_cust_share(base: DataFrame, p: Periods, totals: DataFrame | None = None) -> DataFrame:
    return top_share(base, p, TOP10_CUST_REVENUE, "top10_cust_share", totals)


def yoy_of(p: Periods) -> Column:
    mean = total_of("sale", p.n) / F.col("sale_n").cast("double")
    ye_mean = total_of("ye", p.n) / F.col("ye_n").cast("double")
    return finite(safe_div(mean, ye_mean) * F.lit(100.0))


def yoy_growth_rate(base: DataFrame, p: Periods, totals: DataFrame | None = None) -> DataFrame:
    """Q8: mean monthly sales / mean monthly sales a year earlier * 100,
    each mean over the months present (J6)."""
    sums = _by_merchant(
        base, totals, is_code(SALE_AMOUNT, [*p.months, *p.ye_months]),
        count_of(SALE_AMOUNT, p.months).alias("sale_n"), count_of(SALE_AMOUNT, p.ye_months).alias("ye_n"),
        *month_values(SALE_AMOUNT, p.months, "sale"), *month_values(SALE_AMOUNT, p.ye_months, "ye"),
    )
    return _defined(sums.where("sale_n > 0 and ye_n > 0").select(KEY, yoy_of(p).alias("yoy_growth_rate")), "yoy_growth_rate")
