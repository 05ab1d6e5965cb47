"""A plain-Python model of the scoring rules, for tests.

Follows the published arithmetic: doubles, explicit month pairs, fan-out
joins, rounding of the decimal text half-up.  Zero divisors make a quota
absent (the build's documented choice).
"""

from decimal import ROUND_HALF_UP, Decimal

from merchpulse.plans.periods import next_month, periods
from merchpulse.schema import BANDS_AS_PUBLISHED, QUOTAS, WEIGHTS


def _r2(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def _parse(code, text):
    if code == "M_DEAL_CUST_CNT":
        return float(int(text))
    if code == "M_REFUND_RATE":
        return float(text.replace("%", ""))
    return float(text)


def model_quotas(rows, as_of):
    p = periods(as_of)
    vals = {}  # (k, code, month) -> set of values
    for k, m, code, text in rows:
        in_w = p.start <= m <= p.end
        in_ye = code == "M_SALE_AMOUNT" and p.ye_start <= m <= p.ye_end
        if code in ("M_SALE_AMOUNT", "M_DEAL_CUST_CNT", "M_CUST_ONE_PRICE", "M_REFUND_RATE",
                    "M_TOP3_GOODS_REVENUE", "M_TOP10_CUST_REVENUE") and (in_w or in_ye):
            vals.setdefault((k, code, m), set()).add(_parse(code, text))

    def rows_of(k, code, lo, hi):
        return [(m, v) for (kk, c, m), vs in vals.items() if kk == k and c == code and lo <= m <= hi for v in vs]

    out = {}
    for k in sorted({key[0] for key in vals}):
        sales = rows_of(k, "M_SALE_AMOUNT", p.start, p.end)
        q = dict.fromkeys(QUOTAS)
        total = sum(v for _, v in sales)
        if sales:
            q["avg_sale_amount"] = total / p.n
        deals = rows_of(k, "M_DEAL_CUST_CNT", p.start, p.end)
        if deals:
            q["avg_deal_cnt"] = int(sum(v for _, v in deals)) // p.n
        refunds = rows_of(k, "M_REFUND_RATE", p.start, p.end)
        if sales and refunds and total != 0:
            ra = 0.0
            for m, r in refunds:
                match = [a for mm, a in sales if mm == m] or [0.0]
                ra += sum(r * 0.01 * a for a in match)
            q["refund_rate"] = ra / total * 100
        for name, code in (("sale_amount_cv", "M_SALE_AMOUNT"), ("cust_price_cv", "M_CUST_ONE_PRICE")):
            xs = [v for _, v in rows_of(k, code, p.start, p.end)]
            if len(xs) >= 2:
                mean = sum(xs) / len(xs)
                if mean != 0:
                    sd = (sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) ** 0.5
                    q[name] = sd / mean * 100
        for name, code in (("top3_goods_share", "M_TOP3_GOODS_REVENUE"), ("top10_cust_share", "M_TOP10_CUST_REVENUE")):
            top = rows_of(k, code, p.start, p.end)
            if top and sales and total != 0:
                q[name] = sum(v for _, v in top) / total * 100
        ye = rows_of(k, "M_SALE_AMOUNT", p.ye_start, p.ye_end)
        if sales and ye:
            ye_mean = sum(v for _, v in ye) / len(ye)
            if ye_mean != 0:
                q["yoy_growth_rate"] = (total / len(sales)) / ye_mean * 100
        ratios = []
        for m, a in sales:
            for mm, b in sales:
                if mm != p.end and next_month(mm) == m and b != 0:
                    ratios.append(a / b)
        if ratios:
            q["growth_multiple"] = sum(ratios) / len(ratios) * 100
            q["increase_month_num"] = sum(1 for r in ratios if r >= 1.1)
        for name in QUOTAS:
            if isinstance(q[name], float):
                q[name] = _r2(q[name])
        if any(v is not None for v in q.values()):
            out[k] = tuple(q[name] for name in QUOTAS)
    return out


def model_score(value, band):
    if value is None:
        return None
    cuts, scores = band[0], band[1]
    if len(band) == 3:
        for lo, hi, s in zip(cuts[:-1], cuts[1:], scores):
            if lo <= value < hi:
                return s
        return band[2]
    for cut, s in zip(cuts, scores[:-1]):
        if value < cut:
            return s
    return scores[-1]


def model_final(quota_row):
    num = den = 0.0
    for name, v in zip(QUOTAS, quota_row):
        s = model_score(v, BANDS_AS_PUBLISHED[name])
        if s is not None:
            num += s * WEIGHTS[name]
            den += WEIGHTS[name]
    return 0 if den == 0 else int(num / den * 10 + 0.5)
