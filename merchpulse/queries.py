"""Registered queries: one per operator group, each ``(spark, sf_dir) ->
DataFrame`` over the driver's test tables (see ``oracle.py`` for the
matching oracle SQL).

The metric table is derived from ``lineitem`` and ``orders`` by the
adapter, over all their rows; the reference date is 2000-07-15, so the
window is 200001..200006 and the year-earlier window 199901..199906.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchpulse.functions import calendar as cal
from merchpulse.functions import text as txt
from merchpulse.functions import textdates as td
from merchpulse.functions.numeric import retain_decimal
from merchpulse.operators import growth, quotas
from merchpulse.operators.merge import cogroup_frames, cogroup_values, first_or_default
from merchpulse.operators.slices import base_and_rejects, base_values, metric_slice, shared_slices
from merchpulse.plans import general, single_pass
from merchpulse.plans.job import materialize, score_all, score_one
from merchpulse.plans.periods import periods
from merchpulse.schema import (
    CODE,
    DEAL_CUST_CNT,
    KEY,
    METRIC_CODES,
    MONTH,
    QUOTAS,
    REFUND_RATE,
    SALE_AMOUNT,
)
from merchpulse.sinks import messages
from merchpulse.sinks.text import rows_to_lines
from merchpulse.sources.adapter import load_metric_long, uneven
from merchpulse.sources.metrics import merchant_scan, metric_scan, project

AS_OF = "2000-07-15"
ONE_MERCHANT = "7"
P = periods(AS_OF)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _metrics(spark, sf_dir):
    return load_metric_long(spark, sf_dir)


def _uneven(spark, sf_dir, conflicts=True):
    return uneven(_metrics(spark, sf_dir), conflicts)


def _uneven_base(spark, sf_dir, conflicts=True):
    """Base values of the good rows."""
    return base_and_rejects(_uneven(spark, sf_dir, conflicts), P, on_bad="quarantine")[0]


def _base(spark, sf_dir):
    return base_values(_metrics(spark, sf_dir), P)


def _shared_base(spark, sf_dir):
    """The base for queries with several quota sub-plans: computed once, as a
    table in folders by code (R3)."""
    return shared_slices(_base(spark, sf_dir)).frame


def _rounded(df: DataFrame, name: str) -> DataFrame:
    """A single quota as it appears in the quota table (2 places)."""
    return df.select(KEY, retain_decimal(F.col(name), 2).alias(name))


def q_metric_scan(spark, sf_dir):
    return metric_scan(_metrics(spark, sf_dir))


def q_merchant_scan(spark, sf_dir):
    return merchant_scan(_metrics(spark, sf_dir), ONE_MERCHANT)


def q_metric_slice(spark, sf_dir):
    return metric_slice(_metrics(spark, sf_dir), SALE_AMOUNT, P.start, P.end)


def q_percent_slice(spark, sf_dir):
    return metric_slice(_metrics(spark, sf_dir), REFUND_RATE, P.start, P.end)


def q_base_values(spark, sf_dir):
    """P1-P4 over all six codes: window + year-earlier sales, parsed per
    code, distinct after parsing."""
    return _base(spark, sf_dir).select(KEY, MONTH, CODE, "value")


def q_metric_rejects(spark, sf_dir):
    """V3/V8 quarantine: rows of the analysis windows that cannot be used,
    with the reason, in the uneven metric table."""
    return base_and_rejects(_uneven(spark, sf_dir), P, on_bad="quarantine")[1]


def q_avg_sale_amount(spark, sf_dir):
    return _rounded(quotas.avg_sale_amount(_base(spark, sf_dir), P), "avg_sale_amount")


def q_avg_deal_cnt(spark, sf_dir):
    return quotas.avg_deal_cnt(_base(spark, sf_dir), P)


def q_refund_rate(spark, sf_dir):
    return _rounded(quotas.refund_rate(_base(spark, sf_dir), P), "refund_rate")


def q_sale_amount_cv(spark, sf_dir):
    return _rounded(quotas.sale_amount_cv(_base(spark, sf_dir), P), "sale_amount_cv")


def q_cust_price_cv(spark, sf_dir):
    return _rounded(quotas.cust_price_cv(_base(spark, sf_dir), P), "cust_price_cv")


def q_top3_goods_share(spark, sf_dir):
    return _rounded(quotas.top3_goods_share(_base(spark, sf_dir), P), "top3_goods_share")


def q_top10_cust_share(spark, sf_dir):
    return _rounded(quotas.top10_cust_share(_base(spark, sf_dir), P), "top10_cust_share")


def q_yoy_growth_rate(spark, sf_dir):
    return _rounded(quotas.yoy_growth_rate(_base(spark, sf_dir), P), "yoy_growth_rate")


def q_growth_pairs(spark, sf_dir):
    st = growth.growth_month_stats(_shared_base(spark, sf_dir), P)
    return st.select(KEY, F.col("m").alias(MONTH), "pairs", "ratio_sum", "up")


def q_growth_pair_rows(spark, sf_dir):
    """The pairs themselves, where months have several values."""
    return growth.growth_pair_rows(materialize(_uneven_base(spark, sf_dir)), P)


def q_growth_multiple(spark, sf_dir):
    return _rounded(growth.growth_multiple(_shared_base(spark, sf_dir), P), "growth_multiple")


def q_increase_month_num(spark, sf_dir):
    return growth.increase_month_num(_shared_base(spark, sf_dir), P)


def q_all_quotas(spark, sf_dir):
    return general.all_quotas(_shared_base(spark, sf_dir), P)


def q_all_quotas_single_pass(spark, sf_dir):
    return single_pass.all_quotas(_base(spark, sf_dir), P)


def q_all_quotas_hybrid(spark, sf_dir):
    return single_pass.all_quotas_hybrid(_base(spark, sf_dir), P)


def q_quota_scores(spark, sf_dir):
    return score_all(_metrics(spark, sf_dir), AS_OF).scores


def q_final_scores(spark, sf_dir):
    return score_all(_metrics(spark, sf_dir), AS_OF).final


def q_final_score_one(spark, sf_dir):
    return score_one(_metrics(spark, sf_dir), ONE_MERCHANT, AS_OF).final


COGROUP6_NAMES = ("sale", "deals", "price", "refund", "top3", "top10")


def _cogroup6(base):
    frames = [quotas.code_slice(base, c, P) for c in METRIC_CODES]
    return cogroup_frames(frames, KEY, "value", names=COGROUP6_NAMES, counts=True)


def q_cogroup6(spark, sf_dir):
    """The six code slices of the window merged on the merchant."""
    return _cogroup6(_shared_base(spark, sf_dir))


def q_cogroup6_gaps(spark, sf_dir):
    """J8 where slices are absent and months have several values."""
    return _cogroup6(materialize(_uneven_base(spark, sf_dir)))


def q_cogroup6_values(spark, sf_dir):
    """J8 in long form: every value of the six slices."""
    base = materialize(_uneven_base(spark, sf_dir))
    frames = [quotas.code_slice(base, c, P) for c in METRIC_CODES]
    return cogroup_values(frames, KEY, "value", names=COGROUP6_NAMES).select(KEY, "name", F.col("t0").alias("value"))


def q_cogroup10(spark, sf_dir):
    """The ten quota results merged on the merchant, with element counts."""
    frames = general.quota_frames(_shared_base(spark, sf_dir), P)
    merged = cogroup_frames([frames[q] for q in QUOTAS], KEY, list(QUOTAS), names=list(QUOTAS), counts=True)
    return merged.select(KEY, *[f"{q}_count" for q in QUOTAS])


def _quotas(spark, sf_dir):
    return score_all(_metrics(spark, sf_dir), AS_OF).quotas


def q_quotas_tsv(spark, sf_dir):
    return rows_to_lines(_quotas(spark, sf_dir))


def q_quota_lines(spark, sf_dir):
    return messages.quota_lines(messages.quota_messages(_quotas(spark, sf_dir), AS_OF))


def q_quota_lines_named(spark, sf_dir):
    return messages.quota_lines_named(messages.quota_messages(_quotas(spark, sf_dir), AS_OF))


def q_quota_json(spark, sf_dir):
    return messages.quota_json(_quotas(spark, sf_dir), AS_OF)


def q_quota_json_named(spark, sf_dir):
    return messages.quota_json(_quotas(spark, sf_dir), AS_OF, named=True)


def q_calendar_columns(spark, sf_dir):
    """C1 over event timestamps."""
    ev = _table(spark, sf_dir, "events")
    y, mo, d = cal.calendar_parts("ts")
    return ev.select(
        "event_id",
        cal.format_ts("ts", "yyyy-MM-dd HH:mm:ss").alias("as_text"),
        cal.days_ago("ts", 1).alias("days_ago"),
        cal.months_ago("ts", 1, "yyyyMM").alias("months_ago"),
        cal.year_ago("ts", 1).alias("year_ago"),
        cal.time_ago("ts", 3, "HOUR").alias("hours_ago"),
        cal.months_ago_with_max_day("ts", 1).alias("month_end_ago"),
        cal.days_in_month("ts").alias("days_in_month"),
        y.alias("year"),
        mo.alias("month"),
        d.alias("day"),
        cal.millis_to_text(F.unix_millis(F.col("ts").cast("timestamp"))).alias("from_millis"),
    )


def q_calendar_enrich(spark, sf_dir):
    """C1 as one job: every calendar column for the order dates, one period back."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return cal.enrich(o, "o_orderdate", m=1)


def q_week_bounds(spark, sf_dir):
    """D7 over order dates, one and zero weeks back."""
    o = _table(spark, sf_dir, "orders")
    b1, e1 = cal.week_bounds("o_orderdate", 1)
    b0, e0 = cal.week_bounds("o_orderdate", 0)
    return o.select("o_orderkey", b0.alias("week_begin"), e0.alias("week_end"), b1.alias("prev_week_begin"),
                    e1.alias("prev_week_end"))


def q_quarter_start(spark, sf_dir):
    """D8 over event timestamps, keeping the time of day."""
    ev = _table(spark, sf_dir, "events")
    return ev.select("event_id", cal.quarter_start("ts", "yyyy-MM-dd HH:mm:ss").alias("quarter_start"))


def order_note(o: DataFrame) -> DataFrame:
    """Free text with a date in one of several spellings, derived per order
    from its status: ``F`` -> ``yyyy/M/d``, ``O`` -> ``yyyy-MM-dd``, other
    -> month only ``yyyy-MM``."""
    d = F.col("o_orderdate")
    date_text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy/M/d"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "yyyy-MM-dd"))
        .otherwise(F.date_format(d, "yyyy-MM"))
    )
    note = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" of customer "),
                    F.col("o_custkey").cast("string"), F.lit(" placed "), date_text, F.lit(", priority "),
                    F.col("o_orderpriority"))
    return o.select("o_orderkey", note.alias("note"))


def q_date_text_extract(spark, sf_dir):
    """D12/D13 over order notes."""
    notes = order_note(_table(spark, sf_dir, "orders"))
    return notes.select("o_orderkey", td.cut_year_month_day("note").alias("ymd"),
                        td.cut_year_month("note").alias("ym"))


def q_date_reformat(spark, sf_dir):
    """Extract, normalise separators, parse, re-format as yyyyMMdd."""
    notes = order_note(_table(spark, sf_dir, "orders"))
    ymd = td.normalise_separators(td.cut_year_month_day("note"))
    return notes.select("o_orderkey", td.reformat_date_text(ymd, "yyyy-M-d", "yyyyMMdd").alias("day_key"))


def _padded_customer(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    pad = F.concat(F.lit("\t "), F.col("c_name"), F.lit(" \n"))
    return c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", pad.alias("padded"))


def q_trim_columns(spark, sf_dir):
    """Every field of a customer row as trimmed text."""
    return txt.trim_row(_padded_customer(spark, sf_dir))


def q_trim_array(spark, sf_dir):
    """Part names split on spaces into padded words, trimmed."""
    p = _table(spark, sf_dir, "part")
    words = F.split(F.concat(F.lit(" "), F.col("p_type"), F.lit("\t")), " ")
    trimmed = txt.trim_array(words)
    return p.select("p_partkey", F.size(trimmed).alias("n_words"), F.array_join(trimmed, "|").alias("words"))


def q_retain_decimal(spark, sf_dir):
    """Half-up rounding to 2 places of a computed double."""
    li = _table(spark, sf_dir, "lineitem")
    x = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) / F.lit(7.0)
    return li.select("l_orderkey", "l_linenumber", retain_decimal(x, 2).alias("amount"))


def _first_deals(base):
    sales = quotas.code_slice(base, SALE_AMOUNT, P).select(KEY).distinct()
    deals = quotas.code_slice(base, DEAL_CUST_CNT, P)
    first = deals.groupBy(KEY).agg(first_or_default(F.col("value").cast("bigint"), order=F.col(MONTH)).alias("d"))
    return sales.join(first, KEY, "left").select(KEY, F.coalesce(F.col("d"), F.lit(-1).cast("bigint")).alias(
        "first_deals"))


def q_first_or_default(spark, sf_dir):
    """Per merchant with sales, the deal count of its earliest window
    month with deals, or -1."""
    return _first_deals(_shared_base(spark, sf_dir))


def q_first_or_default_gaps(spark, sf_dir):
    """A7 where some merchants have no deals."""
    return _first_deals(materialize(_uneven_base(spark, sf_dir)))


def q_quotas_gaps(spark, sf_dir):
    """Q12 by the merchant fold where months and codes are absent."""
    return single_pass.all_quotas(_uneven_base(spark, sf_dir, conflicts=False), P)


def q_quotas_conflicts_hybrid(spark, sf_dir):
    """Q12 by the hybrid plan where months have several values."""
    return single_pass.all_quotas_hybrid(_uneven_base(spark, sf_dir), P)


def q_quotas_conflicts_general(spark, sf_dir):
    """Q12 by the published shape where months have several values."""
    return general.all_quotas(materialize(_uneven_base(spark, sf_dir)), P)


def q_quota_scores_gaps(spark, sf_dir):
    return score_all(_uneven(spark, sf_dir), AS_OF, on_bad="quarantine").scores


def q_final_scores_gaps(spark, sf_dir):
    """R1 with absent quotas, rejects and several values in a month."""
    return score_all(_uneven(spark, sf_dir), AS_OF, on_bad="quarantine").final


def q_project_fields(spark, sf_dir):
    """S2 over orders."""
    return project(_table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


def q_project_where(spark, sf_dir):
    """S3 over orders."""
    return project(_table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderdate"], "o_orderdate >= date'1998-01-01'")


QUERIES = {
    "metric_scan": q_metric_scan,
    "merchant_scan": q_merchant_scan,
    "metric_slice": q_metric_slice,
    "percent_slice": q_percent_slice,
    "base_values": q_base_values,
    "metric_rejects": q_metric_rejects,
    "avg_sale_amount": q_avg_sale_amount,
    "avg_deal_cnt": q_avg_deal_cnt,
    "refund_rate": q_refund_rate,
    "sale_amount_cv": q_sale_amount_cv,
    "cust_price_cv": q_cust_price_cv,
    "top3_goods_share": q_top3_goods_share,
    "top10_cust_share": q_top10_cust_share,
    "yoy_growth_rate": q_yoy_growth_rate,
    "growth_pairs": q_growth_pairs,
    "growth_pair_rows": q_growth_pair_rows,
    "growth_multiple": q_growth_multiple,
    "increase_month_num": q_increase_month_num,
    "all_quotas": q_all_quotas,
    "all_quotas_single_pass": q_all_quotas_single_pass,
    "all_quotas_hybrid": q_all_quotas_hybrid,
    "quota_scores": q_quota_scores,
    "final_scores": q_final_scores,
    "final_score_one": q_final_score_one,
    "cogroup6": q_cogroup6,
    "cogroup10": q_cogroup10,
    "quotas_tsv": q_quotas_tsv,
    "quota_lines": q_quota_lines,
    "quota_lines_named": q_quota_lines_named,
    "quota_json": q_quota_json,
    "quota_json_named": q_quota_json_named,
    "calendar_columns": q_calendar_columns,
    "calendar_enrich": q_calendar_enrich,
    "week_bounds": q_week_bounds,
    "quarter_start": q_quarter_start,
    "date_text_extract": q_date_text_extract,
    "date_reformat": q_date_reformat,
    "trim_columns": q_trim_columns,
    "trim_array": q_trim_array,
    "retain_decimal": q_retain_decimal,
    "first_or_default": q_first_or_default,
    "project_fields": q_project_fields,
    "project_where": q_project_where,
    "quotas_gaps": q_quotas_gaps,
    "quotas_conflicts_hybrid": q_quotas_conflicts_hybrid,
    "quotas_conflicts_general": q_quotas_conflicts_general,
    "quota_scores_gaps": q_quota_scores_gaps,
    "final_scores_gaps": q_final_scores_gaps,
    "cogroup6_gaps": q_cogroup6_gaps,
    "cogroup6_values": q_cogroup6_values,
    "first_or_default_gaps": q_first_or_default_gaps,
}
