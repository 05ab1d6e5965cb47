"""Reference SQL (DuckDB dialect) for the registered queries.

Each entry computes, from the raw test tables, what the matching Spark
query returns.  They share the adapter as a CTE; quota SQL adds doubles in
month order and rounds a double's shortest text half-up.
"""

from __future__ import annotations

from types import SimpleNamespace

# Fixed values, stated here again so that a wrong table in the package differs.
AS_OF = "2000-07-15"
P = SimpleNamespace(
    start="200001", end="200006", ye_start="199901", ye_end="199906", n=6,
    months=("200001", "200002", "200003", "200004", "200005", "200006"),
)
ONE_MERCHANT = "7"
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
QUOTAS = tuple(QUOTA_NAMES)
BANDS = {
    "avg_sale_amount": ((5000, 10000, 15000, 20000, 25000), (1, 3, 5, 6, 8, 10)),
    "avg_deal_cnt": ((750, 1500, 2500, 3000, 4000), (6, 8, 10, 1, 3, 5)),
    "refund_rate": ((5, 7, 10, 20, 35), (10, 8, 6, 5, 3, 1)),
    "sale_amount_cv": ((40, 60, 90), (10, 7, 4, 1)),
    "cust_price_cv": ((20, 40, 70), (10, 7, 4, 1)),
    "top3_goods_share": ((20, 40, 70), (10, 7, 4, 1)),
    "top10_cust_share": ((20, 50, 90), (10, 7, 4, 1)),
    "yoy_growth_rate": ((70, 160, 230), (1, 4, 7, 10)),
    "growth_multiple": ((50, 80, 120, 150), (2, 4, 6, 8, 10)),
    "increase_month_num": ((0, 1, 2, 3, 4, 5), (0, 2, 4, 6, 8), 10),
}
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


def _sum(e: str) -> str:
    """Sum of a double by month order."""
    return f"list_reduce(list({e} ORDER BY m), lambda x, y: x + y)"


def _dbl(e: str) -> str:
    return f"CAST({e} AS DOUBLE)"


def r2(e: str) -> str:
    """Half-up rounding of a double's shortest decimal text to 2 places."""
    return f"CAST(round(CAST(CAST({e} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def _units(e: str) -> str:
    return f"CAST(CAST({e} AS DECIMAL(18,4)) * 10000 AS BIGINT)"


def _m10(e: str) -> str:
    return f"round(CAST({e} AS DECIMAL(18,4)) * CAST(0.1 AS DECIMAL(2,1)), 2)"


def _text(e: str) -> str:
    return f"CAST(CAST({e} AS DECIMAL(18,2)) AS VARCHAR)"


ADAPTER = f"""
li AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS k, strftime(l_shipdate, '%Y%m') AS m, l_orderkey AS ok, l_partkey AS pk,
         l_returnflag = 'R' AS is_r,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS x
  FROM lineitem),
j AS (SELECT li.*, o.o_custkey AS ck FROM li JOIN orders o ON li.ok = o.o_orderkey),
cust AS (SELECT k, m, ck, SUM(x) AS cx, SUM(CASE WHEN is_r THEN x ELSE 0 END) AS crx,
                COUNT(DISTINCT ok) AS n_orders FROM j GROUP BY k, m, ck),
part AS (SELECT k, m, pk, SUM(x) AS px FROM j GROUP BY k, m, pk),
mon AS (SELECT k, m, SUM(cx) AS sx, SUM(crx) AS rx, SUM(n_orders) AS deals, COUNT(*) AS n_cust
        FROM cust GROUP BY k, m),
t3 AS (SELECT k, m, SUM(px) AS t3 FROM (
         SELECT k, m, px, row_number() OVER (PARTITION BY k, m ORDER BY px DESC, pk) AS rn FROM part)
       WHERE rn <= 3 GROUP BY k, m),
t10 AS (SELECT k, m, SUM(cx) AS t10 FROM (
          SELECT k, m, cx, row_number() OVER (PARTITION BY k, m ORDER BY cx DESC, ck) AS rn FROM cust)
        WHERE rn <= 10 GROUP BY k, m),
wide AS (
  SELECT mon.k, mon.m,
    {_text(_m10('sx'))} AS sale,
    CAST(CAST(deals AS BIGINT) AS VARCHAR) AS deals,
    {_text(f"({_units('sx')} // (1000 * n_cust)) * CAST(0.01 AS DECIMAL(3,2))")} AS price,
    CASE WHEN {_units('sx')} > 0 THEN
      {_text(f"({_units('rx')} * 10000 // {_units('sx')}) * CAST(0.01 AS DECIMAL(3,2))")} || '%' END AS refund,
    {_text(_m10('t3.t3'))} AS top3,
    {_text(_m10('t10.t10'))} AS top10
  FROM mon LEFT JOIN t3 ON mon.k = t3.k AND mon.m = t3.m LEFT JOIN t10 ON mon.k = t10.k AND mon.m = t10.m),
metric_long AS (
  SELECT * FROM (
    SELECT k AS property_uuid, m AS target_time, 'M_SALE_AMOUNT' AS metric_dim_code, sale AS metric_value FROM wide
    UNION ALL SELECT k, m, 'M_DEAL_CUST_CNT', deals FROM wide
    UNION ALL SELECT k, m, 'M_CUST_ONE_PRICE', price FROM wide
    UNION ALL SELECT k, m, 'M_REFUND_RATE', refund FROM wide
    UNION ALL SELECT k, m, 'M_TOP3_GOODS_REVENUE', top3 FROM wide
    UNION ALL SELECT k, m, 'M_TOP10_CUST_REVENUE', top10 FROM wide)
  WHERE metric_value IS NOT NULL)
"""


def with_adapter(body: str, extra_ctes: str = "") -> str:
    ctes = ADAPTER.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body}"


_W = f"m BETWEEN '{P.start}' AND '{P.end}'"
_YE = f"m BETWEEN '{P.ye_start}' AND '{P.ye_end}'"
_CODES = ", ".join(f"'{c}'" for c in ("M_SALE_AMOUNT", "M_DEAL_CUST_CNT", "M_CUST_ONE_PRICE", "M_REFUND_RATE",
                                       "M_TOP3_GOODS_REVENUE", "M_TOP10_CUST_REVENUE"))
_PREV = ", ".join(f"('{b}', '{a}')" for a, b in zip(P.months[:-1], P.months[1:]))
_D = "CAST({} AS DOUBLE)"

QUOTA_CTES = f"""
base AS (
  SELECT DISTINCT property_uuid AS k, target_time AS m, metric_dim_code AS c,
    CASE metric_dim_code
      WHEN 'M_DEAL_CUST_CNT' THEN CAST(CAST(metric_value AS INTEGER) AS DOUBLE)
      WHEN 'M_REFUND_RATE' THEN CAST(replace(metric_value, '%', '') AS DOUBLE)
      ELSE CAST(metric_value AS DOUBLE) END AS v
  FROM metric_long
  WHERE metric_dim_code IN ({_CODES})
    AND (target_time BETWEEN '{P.start}' AND '{P.end}'
         OR (metric_dim_code = 'M_SALE_AMOUNT' AND target_time BETWEEN '{P.ye_start}' AND '{P.ye_end}'))),
w AS (SELECT * FROM base WHERE {_W}),
cm AS (SELECT k, m, c, SUM(v) AS v, COUNT(*) AS n FROM base GROUP BY k, m, c),
sales AS (SELECT k, {_sum('v')} AS total, SUM(n) AS n FROM cm WHERE c = 'M_SALE_AMOUNT' AND {_W} GROUP BY k),
ye AS (SELECT k, {_sum('v')} AS total, SUM(n) AS n FROM cm WHERE c = 'M_SALE_AMOUNT' AND {_YE} GROUP BY k),
q1 AS (SELECT k, CAST(total AS DOUBLE) / CAST({P.n} AS DOUBLE) AS avg_sale_amount FROM sales),
q2 AS (SELECT k, CAST(SUM(CAST(v AS BIGINT)) // {P.n} AS BIGINT) AS avg_deal_cnt
       FROM w WHERE c = 'M_DEAL_CUST_CNT' GROUP BY k),
sm AS (SELECT k, m, v AS sa FROM cm WHERE c = 'M_SALE_AMOUNT' AND {_W}),
rm AS (SELECT k, m, v AS sr FROM cm WHERE c = 'M_REFUND_RATE' AND {_W}),
rs AS (SELECT rm.k, rm.m, rm.sr * COALESCE(sm.sa, CAST(0 AS DOUBLE)) AS x
       FROM rm LEFT JOIN sm ON rm.k = sm.k AND rm.m = sm.m),
ra AS (SELECT k, {_sum('x')} AS ra FROM rs GROUP BY k),
q3 AS (SELECT ra.k, ra.ra * CAST(0.01 AS DOUBLE) / sales.total * CAST(100 AS DOUBLE) AS refund_rate
       FROM ra JOIN sales ON ra.k = sales.k WHERE sales.total <> 0),
cv AS (SELECT k, c, stddev_samp(v) / avg(v) * CAST(100 AS DOUBLE) AS cv
       FROM w WHERE c IN ('M_SALE_AMOUNT', 'M_CUST_ONE_PRICE') GROUP BY k, c HAVING count(*) >= 2 AND avg(v) <> 0),
q4 AS (SELECT k, cv AS sale_amount_cv FROM cv WHERE c = 'M_SALE_AMOUNT'),
q5 AS (SELECT k, cv AS cust_price_cv FROM cv WHERE c = 'M_CUST_ONE_PRICE'),
tops AS (SELECT k, c, {_sum('v')} AS top FROM cm
         WHERE {_W} AND c IN ('M_TOP3_GOODS_REVENUE', 'M_TOP10_CUST_REVENUE') GROUP BY k, c),
topq AS (SELECT tops.k, tops.c, CAST(top AS DOUBLE) / CAST(total AS DOUBLE) * CAST(100 AS DOUBLE) AS share
         FROM tops JOIN sales ON tops.k = sales.k WHERE sales.total <> 0),
q6 AS (SELECT k, share AS top3_goods_share FROM topq WHERE c = 'M_TOP3_GOODS_REVENUE'),
q7 AS (SELECT k, share AS top10_cust_share FROM topq WHERE c = 'M_TOP10_CUST_REVENUE'),
q8 AS (SELECT s.k, (CAST(s.total AS DOUBLE) / CAST(s.n AS DOUBLE)) / (CAST(ye.total AS DOUBLE) / CAST(ye.n AS DOUBLE))
              * CAST(100 AS DOUBLE) AS yoy_growth_rate
       FROM sales s JOIN ye ON s.k = ye.k WHERE ye.total <> 0),
sv AS (SELECT k, m, v FROM w WHERE c = 'M_SALE_AMOUNT'),
prev(m, pm) AS (VALUES {_PREV}),
pairs AS (SELECT a.k, a.m, a.v / b.v AS ratio FROM sv a JOIN prev ON a.m = prev.m
          JOIN sv b ON b.k = a.k AND b.m = prev.pm WHERE b.v <> 0),
gm AS (SELECT k, m, COUNT(*) AS pairs, SUM(ratio) AS ratio_sum,
              SUM(CASE WHEN ratio >= CAST(1.1 AS DOUBLE) THEN 1 ELSE 0 END) AS up FROM pairs GROUP BY k, m),
g AS (SELECT k, list_reduce(list(ratio_sum ORDER BY m), lambda x, y: x + y) / CAST(SUM(pairs) AS DOUBLE)
             * CAST(100 AS DOUBLE) AS growth_multiple,
             CAST(SUM(up) AS INTEGER) AS increase_month_num FROM gm GROUP BY k),
q9 AS (SELECT k, growth_multiple FROM g),
q10 AS (SELECT k, increase_month_num FROM g),
keys AS (SELECT k FROM q1 UNION SELECT k FROM q2 UNION SELECT k FROM q3 UNION SELECT k FROM q4
         UNION SELECT k FROM q5 UNION SELECT k FROM q6 UNION SELECT k FROM q7 UNION SELECT k FROM q8
         UNION SELECT k FROM q9 UNION SELECT k FROM q10),
quotas AS (
  SELECT keys.k AS property_uuid,
    {r2('q1.avg_sale_amount')} AS avg_sale_amount,
    q2.avg_deal_cnt AS avg_deal_cnt,
    {r2('q3.refund_rate')} AS refund_rate,
    {r2('q4.sale_amount_cv')} AS sale_amount_cv,
    {r2('q5.cust_price_cv')} AS cust_price_cv,
    {r2('q6.top3_goods_share')} AS top3_goods_share,
    {r2('q7.top10_cust_share')} AS top10_cust_share,
    {r2('q8.yoy_growth_rate')} AS yoy_growth_rate,
    {r2('q9.growth_multiple')} AS growth_multiple,
    q10.increase_month_num AS increase_month_num
  FROM keys
  LEFT JOIN q1 ON q1.k = keys.k LEFT JOIN q2 ON q2.k = keys.k LEFT JOIN q3 ON q3.k = keys.k
  LEFT JOIN q4 ON q4.k = keys.k LEFT JOIN q5 ON q5.k = keys.k LEFT JOIN q6 ON q6.k = keys.k
  LEFT JOIN q7 ON q7.k = keys.k LEFT JOIN q8 ON q8.k = keys.k LEFT JOIN q9 ON q9.k = keys.k
  LEFT JOIN q10 ON q10.k = keys.k)
"""


def _score_sql(col: str, band) -> str:
    v = f"CAST({col} AS DOUBLE)"
    cuts, scores = band[0], band[1]
    parts = [f"CASE WHEN {v} IS NULL OR isnan({v}) THEN NULL"]
    if len(band) == 3:
        for lo, hi, s in zip(cuts[:-1], cuts[1:], scores):
            parts.append(f"WHEN {v} >= {lo} AND {v} < {hi} THEN {s}")
        parts.append(f"ELSE {band[2]} END")
    else:
        for cut, s in zip(cuts, scores[:-1]):
            parts.append(f"WHEN {v} < {cut} THEN {s}")
        parts.append(f"ELSE {scores[-1]} END")
    return "CAST(" + " ".join(parts) + " AS INTEGER)"


def _scores_cte() -> str:
    cols = ",\n    ".join(f"{_score_sql(q, BANDS[q])} AS s_{q}" for q in QUOTAS)
    return f"scores AS (SELECT property_uuid,\n    {cols}\n  FROM quotas)"


def _final_cte() -> str:
    num = " + ".join(
        f"(CASE WHEN s_{q} IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(s_{q} AS DOUBLE) * CAST({WEIGHTS[q]!r} AS DOUBLE) END)"
        for q in QUOTAS
    )
    den = " + ".join(
        f"(CASE WHEN s_{q} IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST({WEIGHTS[q]!r} AS DOUBLE) END)" for q in QUOTAS
    )
    return (
        f"final AS (SELECT property_uuid, CASE WHEN ({den}) = 0 THEN CAST(0 AS BIGINT) ELSE "
        f"CAST(floor(({num}) / ({den}) * CAST(10 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) END AS final_score "
        f"FROM scores)"
    )


_PARSED = ("CASE metric_dim_code WHEN 'M_DEAL_CUST_CNT' THEN CAST(TRY_CAST(metric_value AS INTEGER) AS DOUBLE) "
           "WHEN 'M_REFUND_RATE' THEN TRY_CAST(replace(metric_value, '%', '') AS DOUBLE) "
           "ELSE TRY_CAST(metric_value AS DOUBLE) END")


def _p5(units: str) -> str:
    return f"CAST(CAST(CAST({units} AS DECIMAL(18,0)) * CAST(0.00001 AS DECIMAL(5,5)) AS DECIMAL(18,5)) AS VARCHAR)"


def _uneven_ctes(conflicts: bool = True) -> str:
    """The uneven metric table (see the adapter's description) and its good rows."""
    amount = """cents * (d + 1) * 10 * CASE WHEN c IN ('M_TOP3_GOODS_REVENUE', 'M_TOP10_CUST_REVENUE') THEN 10 - d
      WHEN m = '200006' AND d > 6 THEN 50 WHEN m LIKE '1999%' AND d IN (2, 3) THEN 30 ELSE 10 END"""
    price = "cents * 1000 * CASE WHEN substr(m, 5, 2) = '05' AND d > 5 THEN 6 ELSE 1 END"
    second = f"UNION ALL SELECT k, m, c, {_p5('amount + 12345')} FROM u3 WHERE c = 'M_SALE_AMOUNT' AND z = '1'"
    return f"""u1 AS (
  SELECT property_uuid AS k, target_time AS m, metric_dim_code AS c, replace(metric_value, '%', '') AS num,
         CAST(right(property_uuid, 1) AS BIGINT) AS d FROM metric_long),
u2 AS (
  SELECT *, right(num, 1) AS z,
         CASE WHEN c <> 'M_DEAL_CUST_CNT' THEN CAST(CAST(num AS DECIMAL(18,2)) * 100 AS BIGINT) END AS cents FROM u1
  WHERE right(num, 1) <> '3' AND NOT (c = 'M_DEAL_CUST_CNT' AND d = 0) AND NOT (c = 'M_TOP10_CUST_REVENUE' AND d = 4)
    AND NOT (c = 'M_REFUND_RATE' AND d = 5) AND NOT (c = 'M_SALE_AMOUNT' AND d = 6)),
u3 AS (
  SELECT *, {amount} AS amount,
    CASE c WHEN 'M_DEAL_CUST_CNT' THEN CAST(TRY_CAST(num AS BIGINT) * 9 * d * d AS VARCHAR)
      WHEN 'M_CUST_ONE_PRICE' THEN {_p5(price)}
      WHEN 'M_REFUND_RATE' THEN {_p5('cents * (d + 1) * 100')} || '%'
      ELSE {_p5(amount)} END AS t FROM u2),
uneven(property_uuid, target_time, metric_dim_code, metric_value) AS (
  SELECT k, m, c, t FROM u3
  UNION ALL SELECT k, m, c, t FROM u3 WHERE z = '2'
  UNION ALL SELECT k, m, c, t || '0' FROM u3
    WHERE z = '0' AND c IN ('M_SALE_AMOUNT', 'M_TOP3_GOODS_REVENUE', 'M_TOP10_CUST_REVENUE')
  {second if conflicts else ''}
  UNION ALL SELECT k, m, c, 'n/a' FROM u3 WHERE z = '9'
  UNION ALL SELECT k, m, c, NULL FROM u3 WHERE c = 'M_CUST_ONE_PRICE' AND z = '8'),
good AS (SELECT * FROM uneven WHERE {_PARSED} IS NOT NULL)"""


def _gaps(body: str, extra: str = "", conflicts: bool = True) -> str:
    """Quota SQL over the good rows of the uneven table."""
    quotas = QUOTA_CTES.strip().replace("FROM metric_long", "FROM good")
    return with_adapter(body, ",\n".join(filter(None, [_uneven_ctes(conflicts), quotas, extra])))


def _q(body: str, extra: str = "") -> str:
    ctes = QUOTA_CTES.strip()
    if extra:
        ctes += ",\n" + extra
    return with_adapter(body, ctes)


def _value_text(col: str) -> str:
    return f"COALESCE(CAST({col} AS VARCHAR), 'None')"


def _tsv_sql() -> str:
    fields = ", ".join(["property_uuid"] + [_value_text(q) for q in QUOTAS])
    return _q(f"SELECT concat_ws(chr(9), {fields}) AS value FROM quotas")


def _messages_cte() -> str:
    month = AS_OF[:4] + AS_OF[5:7]
    parts = []
    for i, q in enumerate(QUOTAS):
        parts.append(
            f"SELECT 'merchant_health' AS item, property_uuid, {i} AS pos, '{q}' AS code, '{QUOTA_NAMES[q]}' AS name, "
            f"'2' AS flag, '{month}' AS t, {_value_text(q)} AS vt FROM quotas"
        )
    return "msgs AS (" + "\nUNION ALL ".join(parts) + ")"


def _json_sql(named: bool) -> str:
    month = AS_OF[:4] + AS_OF[5:7]
    items = []
    for q in QUOTAS:
        name = f'"quotaName":"{QUOTA_NAMES[q]}",' if named else ""
        items.append(
            f"'{{\"indexFlag\":\"2\",{name}\"quotaCode\":\"{q}\",\"targetTime\":\"{month}\",\"quotaValue\":' || "
            f"COALESCE(CAST({q} AS VARCHAR), 'null') || '}}'"
        )
    body = " || ',' || ".join(items)
    return _q(
        "SELECT property_uuid, '{\"quotaItemName\":\"merchant_health\",\"propertyUuid\":\"' || property_uuid || "
        f"'\",\"quotaItemList\":[' || {body} || ']}}' AS json FROM quotas"
    )


def _java_trim(e: str) -> str:
    return f"regexp_replace({e}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


ORDER_NOTE = """
notes AS (
  SELECT o_orderkey, 'order ' || CAST(o_orderkey AS VARCHAR) || ' of customer ' || CAST(o_custkey AS VARCHAR)
    || ' placed ' || CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y') || '/'
                            || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR)
                          WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                          ELSE strftime(o_orderdate, '%Y-%m') END
    || ', priority ' || o_orderpriority AS note
  FROM orders)
"""
_YMD = r"\d{4}(/|-)\d{1,2}(/|-)\d{1,2}"
_YM = r"\d{4}(/|-)\d{1,2}"


def oracle_sql() -> dict[str, str]:
    q = {}
    q["metric_scan"] = with_adapter(
        f"SELECT property_uuid, target_time, metric_dim_code, metric_value FROM metric_long "
        f"WHERE metric_dim_code IN ({_CODES})"
    )
    q["merchant_scan"] = with_adapter(
        f"SELECT property_uuid, target_time, metric_dim_code, metric_value FROM metric_long "
        f"WHERE metric_dim_code IN ({_CODES}) AND property_uuid = '{ONE_MERCHANT}'"
    )
    q["metric_slice"] = with_adapter(
        "SELECT DISTINCT property_uuid, target_time, CAST(metric_value AS DOUBLE) AS value FROM metric_long "
        f"WHERE metric_dim_code = 'M_SALE_AMOUNT' AND target_time >= '{P.start}' AND target_time <= '{P.end}'"
    )
    q["percent_slice"] = with_adapter(
        "SELECT DISTINCT property_uuid, target_time, CAST(replace(metric_value, '%', '') AS DOUBLE) AS value "
        f"FROM metric_long WHERE metric_dim_code = 'M_REFUND_RATE' AND target_time >= '{P.start}' "
        f"AND target_time <= '{P.end}'"
    )
    q["metric_rejects"] = with_adapter(
        "SELECT property_uuid, target_time, metric_dim_code, metric_value, reason FROM ("
        "SELECT *, CASE WHEN metric_value IS NULL THEN 'null value' "
        "WHEN target_time IS NULL OR NOT regexp_full_match(target_time, '\\d{4}(0[1-9]|1[0-2])') THEN 'bad month' "
        f"WHEN {_PARSED} IS NULL THEN 'unparsable value' "
        f"WHEN isnan({_PARSED}) OR isinf({_PARSED}) THEN 'non-finite value' END AS reason "
        f"FROM uneven WHERE metric_dim_code IN ({_CODES}) AND (target_time BETWEEN '{P.start}' AND '{P.end}' "
        f"OR (metric_dim_code = 'M_SALE_AMOUNT' AND target_time BETWEEN '{P.ye_start}' AND '{P.ye_end}'))) "
        "WHERE reason IS NOT NULL",
        _uneven_ctes(),
    )
    q["base_values"] = _q("SELECT k AS property_uuid, m AS target_time, c AS metric_dim_code, v AS value FROM base")
    single = {
        "avg_sale_amount": "q1",
        "refund_rate": "q3",
        "sale_amount_cv": "q4",
        "cust_price_cv": "q5",
        "top3_goods_share": "q6",
        "top10_cust_share": "q7",
        "yoy_growth_rate": "q8",
        "growth_multiple": "q9",
    }
    for name, cte in single.items():
        q[name] = _q(f"SELECT k AS property_uuid, {r2(name)} AS {name} FROM {cte}")
    q["avg_deal_cnt"] = _q("SELECT k AS property_uuid, avg_deal_cnt FROM q2")
    q["increase_month_num"] = _q("SELECT k AS property_uuid, increase_month_num FROM q10")
    q["growth_pairs"] = _q(
        "SELECT k AS property_uuid, m AS target_time, CAST(pairs AS BIGINT) AS pairs, ratio_sum, "
        "CAST(up AS BIGINT) AS up FROM gm"
    )
    q["growth_pair_rows"] = _gaps(
        "SELECT a.k AS property_uuid, a.m AS target_time, a.v AS a, b.v AS b, a.v / b.v AS ratio FROM sv a "
        "JOIN prev ON a.m = prev.m JOIN sv b ON b.k = a.k AND b.m = prev.pm WHERE b.v <> 0"
    )
    q["all_quotas"] = _q("SELECT * FROM quotas")
    q["all_quotas_single_pass"] = q["all_quotas"]
    q["all_quotas_hybrid"] = q["all_quotas"]
    q["quota_scores"] = _q("SELECT * FROM scores", _scores_cte())
    q["final_scores"] = _q("SELECT * FROM final", _scores_cte() + ",\n" + _final_cte())
    q["final_score_one"] = _q(
        f"SELECT * FROM final WHERE property_uuid = '{ONE_MERCHANT}'", _scores_cte() + ",\n" + _final_cte()
    )
    names6 = ("sale", "deals", "price", "refund", "top3", "top10")
    codes6 = ("M_SALE_AMOUNT", "M_DEAL_CUST_CNT", "M_CUST_ONE_PRICE", "M_REFUND_RATE", "M_TOP3_GOODS_REVENUE",
              "M_TOP10_CUST_REVENUE")
    sel = ", ".join(
        f"MIN(CASE WHEN c = '{c}' THEN v END) AS {n}, COUNT(CASE WHEN c = '{c}' THEN 1 END) AS {n}_count"
        for c, n in zip(codes6, names6)
    )
    q["cogroup6"] = _q(f"SELECT k AS property_uuid, {sel} FROM w GROUP BY k")
    q["cogroup6_gaps"] = _gaps(f"SELECT k AS property_uuid, {sel} FROM w GROUP BY k")
    case = " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in zip(codes6, names6))
    q["cogroup6_values"] = _gaps(f"SELECT k AS property_uuid, CASE c {case} END AS name, v AS value FROM w")
    q["quotas_gaps"] = _gaps("SELECT * FROM quotas", conflicts=False)
    q["quotas_conflicts_hybrid"] = _gaps("SELECT * FROM quotas")
    q["quotas_conflicts_general"] = q["quotas_conflicts_hybrid"]
    q["quota_scores_gaps"] = _gaps("SELECT * FROM scores", _scores_cte())
    q["final_scores_gaps"] = _gaps("SELECT * FROM final", _scores_cte() + ",\n" + _final_cte())
    q["project_fields"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"
    q["project_where"] = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-01-01'"
    q["cogroup10"] = _q(
        "SELECT property_uuid, "
        + ", ".join(f"CAST(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END AS BIGINT) AS {c}_count" for c in QUOTAS)
        + " FROM quotas"
    )
    q["quotas_tsv"] = _tsv_sql()
    q["quota_lines"] = _q(
        "SELECT concat_ws(chr(9), item, property_uuid, code, flag, t, vt) AS value FROM msgs", _messages_cte()
    )
    q["quota_lines_named"] = _q(
        "SELECT concat_ws(chr(9), property_uuid, item, code, name, flag, t, vt) AS value FROM msgs", _messages_cte()
    )
    q["quota_json"] = _json_sql(named=False)
    q["quota_json_named"] = _json_sql(named=True)
    q["calendar_columns"] = (
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS as_text,"
        " strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS days_ago,"
        " strftime(ts - INTERVAL 1 MONTH, '%Y%m') AS months_ago,"
        " strftime(ts - INTERVAL 1 YEAR, '%Y-%m-%d') AS year_ago,"
        " ts - INTERVAL 3 HOUR AS hours_ago,"
        " strftime(last_day(ts - INTERVAL 1 MONTH), '%Y-%m-%d') AS month_end_ago,"
        " CAST(day(last_day(ts)) AS INTEGER) AS days_in_month,"
        " CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,"
        " strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS from_millis"
        " FROM events"
    )
    d = "o_orderdate"
    q["calendar_enrich"] = (
        f"SELECT o_orderkey, {d}, strftime({d}, '%Y-%m-%d') AS as_text,"
        f" strftime({d} - INTERVAL 1 DAY, '%Y-%m-%d') AS days_ago,"
        f" strftime({d} - INTERVAL 1 MONTH, '%Y-%m-%d') AS months_ago,"
        f" strftime({d} - INTERVAL 1 YEAR, '%Y-%m-%d') AS year_ago,"
        f" strftime(last_day({d} - INTERVAL 1 MONTH), '%Y-%m-%d') AS month_end_ago,"
        f" strftime(CAST(date_trunc('week', {d}) AS DATE) - 7, '%Y-%m-%d') AS week_begin,"
        f" strftime(CAST(date_trunc('week', {d}) AS DATE) - 1, '%Y-%m-%d') AS week_end,"
        f" strftime(date_trunc('quarter', {d}), '%Y-%m-%d') AS quarter_start,"
        f" CAST(day(last_day({d})) AS INTEGER) AS days_in_month,"
        f" CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month,"
        f" CAST(day({d}) AS INTEGER) AS day FROM orders"
    )
    q["week_bounds"] = (
        "SELECT o_orderkey,"
        " strftime(CAST(date_trunc('week', o_orderdate) AS DATE), '%Y-%m-%d') AS week_begin,"
        " strftime(CAST(date_trunc('week', o_orderdate) AS DATE) + 6, '%Y-%m-%d') AS week_end,"
        " strftime(CAST(date_trunc('week', o_orderdate) AS DATE) - 7, '%Y-%m-%d') AS prev_week_begin,"
        " strftime(CAST(date_trunc('week', o_orderdate) AS DATE) - 1, '%Y-%m-%d') AS prev_week_end"
        " FROM orders"
    )
    q["quarter_start"] = (
        "SELECT event_id, strftime(date_trunc('quarter', ts) + (ts - date_trunc('day', ts)), '%Y-%m-%d %H:%M:%S')"
        " AS quarter_start FROM events"
    )
    q["date_text_extract"] = (
        f"WITH {ORDER_NOTE.strip()} SELECT o_orderkey, regexp_extract(note, '{_YMD}', 0) AS ymd, "
        f"regexp_extract(note, '{_YM}', 0) AS ym FROM notes"
    )
    q["date_reformat"] = (
        f"WITH {ORDER_NOTE.strip()} SELECT o_orderkey, "
        f"strftime(try_strptime(replace(regexp_extract(note, '{_YMD}', 0), '/', '-'), '%Y-%m-%d'), '%Y%m%d') "
        "AS day_key FROM notes"
    )
    pad = "chr(9) || ' ' || c_name || ' ' || chr(10)"
    q["trim_columns"] = (
        f"SELECT {_java_trim('CAST(c_custkey AS VARCHAR)')} AS c_custkey, {_java_trim('c_name')} AS c_name, "
        f"{_java_trim('CAST(c_nationkey AS VARCHAR)')} AS c_nationkey, {_java_trim('c_mktsegment')} AS c_mktsegment, "
        f"{_java_trim(pad)} AS padded FROM customer"
    )
    q["trim_array"] = (
        "SELECT p_partkey, CAST(len(t) AS INTEGER) AS n_words, array_to_string(t, '|') AS words FROM ("
        f"SELECT p_partkey, list_transform(string_split(' ' || p_type || chr(9), ' '), lambda z: {_java_trim('z')}) AS t"
        " FROM part)"
    )
    q["retain_decimal"] = (
        "SELECT l_orderkey, l_linenumber, "
        + r2("l_extendedprice * (CAST(1 AS DOUBLE) - l_discount) / CAST(7 AS DOUBLE)")
        + " AS amount FROM lineitem"
    )
    first = (
        "SELECT s.k AS property_uuid, COALESCE(f.d, -1) AS first_deals FROM "
        "(SELECT DISTINCT k FROM w WHERE c = 'M_SALE_AMOUNT') s LEFT JOIN "
        "(SELECT k, CAST(arg_min(v, m) AS BIGINT) AS d FROM w WHERE c = 'M_DEAL_CUST_CNT' GROUP BY k) f ON s.k = f.k"
    )
    q["first_or_default"] = _q(first)
    q["first_or_default_gaps"] = _gaps(first)
    return q
