"""General plan: one sub-plan per quota, merged on the merchant key.

Exact for every input, including several values for one month.  The quotas
that need month sums share one table of month totals (at most one row for each
month and code of a merchant), growth is folded once and feeds both its
quotas; both are materialised.  ``merge_quotas`` folds the ten results in one
more shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchpulse.operators import growth, quotas
from merchpulse.operators.merge import merge_quotas, round_quotas
from merchpulse.operators.sums import month_totals
from merchpulse.plans.periods import Periods
from merchpulse.schema import CODE, CUST_ONE_PRICE, DEAL_CUST_CNT, KEY
from merchpulse.session import cut_lineage


def quota_frames(base: DataFrame, p: Periods) -> dict[str, DataFrame]:
    # one row for each merchant, read by the two growth quotas and by the two variations
    g = cut_lineage(growth.growth_per_merchant(growth.growth_month_stats(base, p)))
    cv = cut_lineage(quotas.variations(base, p))
    # price and deals need no month sums
    totals = cut_lineage(month_totals(base.where(~F.col(CODE).isin(CUST_ONE_PRICE, DEAL_CUST_CNT))))
    return {
        "avg_sale_amount": quotas.avg_sale_amount(base, p, totals),
        "avg_deal_cnt": quotas.avg_deal_cnt(base, p),
        "refund_rate": quotas.refund_rate(base, p, totals),
        "sale_amount_cv": cv.select(KEY, "sale_amount_cv"),
        "cust_price_cv": cv.select(KEY, "cust_price_cv"),
        "top3_goods_share": quotas.top3_goods_share(base, p, totals),
        "top10_cust_share": quotas.top10_cust_share(base, p, totals),
        "yoy_growth_rate": quotas.yoy_growth_rate(base, p, totals),
        "growth_multiple": g.select(KEY, "growth_multiple"),
        "increase_month_num": g.select(KEY, "increase_month_num"),
    }


def all_quotas(base: DataFrame, p: Periods) -> DataFrame:
    """Q12 by the general plan."""
    return round_quotas(merge_quotas(quota_frames(base, p)))
