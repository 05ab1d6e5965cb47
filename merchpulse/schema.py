"""Schemas, metric codes, quota names, band and weight tables.

Everything here is data, not code: the operators take these tables as
arguments so a caller can swap them.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "property_uuid"
MONTH = "target_time"
CODE = "metric_dim_code"
VALUE = "metric_value"

METRIC_LONG = T.StructType(
    [
        T.StructField(KEY, T.StringType(), False),
        T.StructField(MONTH, T.StringType(), True),
        T.StructField(CODE, T.StringType(), True),
        T.StructField(VALUE, T.StringType(), True),
    ]
)

# The six metric codes of the input table, as published.
SALE_AMOUNT = "M_SALE_AMOUNT"
DEAL_CUST_CNT = "M_DEAL_CUST_CNT"
CUST_ONE_PRICE = "M_CUST_ONE_PRICE"
REFUND_RATE = "M_REFUND_RATE"
TOP3_GOODS_REVENUE = "M_TOP3_GOODS_REVENUE"
TOP10_CUST_REVENUE = "M_TOP10_CUST_REVENUE"
METRIC_CODES = (
    SALE_AMOUNT,
    DEAL_CUST_CNT,
    CUST_ONE_PRICE,
    REFUND_RATE,
    TOP3_GOODS_REVENUE,
    TOP10_CUST_REVENUE,
)

# How each code's text is parsed: double, int (strict, "12.0" fails) or a
# percent ("5%" or "5", every "%" removed, then double).
PARSE_KIND = {
    SALE_AMOUNT: "double",
    DEAL_CUST_CNT: "int",
    CUST_ONE_PRICE: "double",
    REFUND_RATE: "percent",
    TOP3_GOODS_REVENUE: "double",
    TOP10_CUST_REVENUE: "double",
}

# The ten quotas in merge (slot) order.
QUOTAS = (
    "avg_sale_amount",
    "avg_deal_cnt",
    "refund_rate",
    "sale_amount_cv",
    "cust_price_cv",
    "top3_goods_share",
    "top10_cust_share",
    "yoy_growth_rate",
    "growth_multiple",
    "increase_month_num",
)
INT_QUOTAS = ("avg_deal_cnt", "increase_month_num")
DOUBLE_QUOTAS = tuple(q for q in QUOTAS if q not in INT_QUOTAS)

QUOTA_TYPES = {
    "avg_sale_amount": T.DoubleType(),
    "avg_deal_cnt": T.LongType(),
    "refund_rate": T.DoubleType(),
    "sale_amount_cv": T.DoubleType(),
    "cust_price_cv": T.DoubleType(),
    "top3_goods_share": T.DoubleType(),
    "top10_cust_share": T.DoubleType(),
    "yoy_growth_rate": T.DoubleType(),
    "growth_multiple": T.DoubleType(),
    "increase_month_num": T.IntegerType(),
}

QUOTAS_SCHEMA = T.StructType(
    [T.StructField(KEY, T.StringType(), False)]
    + [T.StructField(q, QUOTA_TYPES[q], True) for q in QUOTAS]
)

SCORE_PREFIX = "s_"
SCORE_COLUMNS = tuple(SCORE_PREFIX + q for q in QUOTAS)

# Band tables as published.  Each entry is
# (cuts, scores, default): value < cuts[0] -> scores[0],
# cuts[i-1] <= value < cuts[i] -> scores[i], value >= cuts[-1] -> scores[-1]
# unless a default is given, in which case the listed scores cover the
# half-open ranges [cuts[i-1], cuts[i]) only and anything else gets default.
BANDS_BY_NAME = {
    "avg_sale_amount": ((5000, 10000, 15000, 20000, 25000), (1, 3, 5, 6, 8, 10)),
    "avg_deal_cnt": ((750, 1500, 2500, 3000, 4000), (6, 8, 10, 1, 3, 5)),
    "refund_rate": ((5, 7, 10, 20, 35), (10, 8, 6, 5, 3, 1)),
    "sale_amount_cv": ((40, 60, 90), (10, 7, 4, 1)),
    "cust_price_cv": ((20, 40, 70), (10, 7, 4, 1)),
    "top3_goods_share": ((20, 40, 70), (10, 7, 4, 1)),
    "top10_cust_share": ((20, 50, 90), (10, 7, 4, 1)),
    # growth-multiple bands (70, 160, 230) and growth-rate bands
    # (50, 80, 120, 150), named after what they are meant to score
    "growth_multiple": ((70, 160, 230), (1, 4, 7, 10)),
    "yoy_growth_rate": ((50, 80, 120, 150), (2, 4, 6, 8, 10)),
    # months up: exactly 0,1,2,3,4 -> 0,2,4,6,8; anything else 10
    "increase_month_num": ((0, 1, 2, 3, 4, 5), (0, 2, 4, 6, 8), 10),
}

# As published, the year-on-year slot is scored with the 70/160/230 bands
# and the growth-multiple slot with the 50/80/120/150 bands (the two band
# functions are crossed relative to the slot names).  This is the default.
BANDS_AS_PUBLISHED = dict(BANDS_BY_NAME)
BANDS_AS_PUBLISHED["yoy_growth_rate"] = BANDS_BY_NAME["growth_multiple"]
BANDS_AS_PUBLISHED["growth_multiple"] = BANDS_BY_NAME["yoy_growth_rate"]

# Weights per slot, as published (sum 1.0).
WEIGHTS = {
    "avg_sale_amount": 0.25,
    "avg_deal_cnt": 0.1,
    "refund_rate": 0.1,
    "sale_amount_cv": 0.05,
    "cust_price_cv": 0.1,
    "top3_goods_share": 0.1,
    "top10_cust_share": 0.1,
    "yoy_growth_rate": 0.05,
    "growth_multiple": 0.075,
    "increase_month_num": 0.075,
}

# Quota codes and names used in quota messages (the published job leaves
# them to the caller; these are defaults).
QUOTA_NAMES = {
    "avg_sale_amount": "mean monthly sales",
    "avg_deal_cnt": "mean monthly deals",
    "refund_rate": "refund rate",
    "sale_amount_cv": "sales coefficient of variation",
    "cust_price_cv": "unit price coefficient of variation",
    "top3_goods_share": "top-3 goods share",
    "top10_cust_share": "top-10 customer share",
    "yoy_growth_rate": "year-on-year growth",
    "growth_multiple": "month-on-month growth multiple",
    "increase_month_num": "months of growth",
}

WINDOW_MONTHS = 6
GROWTH_THRESHOLD = 1.1
