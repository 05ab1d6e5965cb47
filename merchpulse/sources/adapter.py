"""Test-table adapter: ``lineitem`` + ``orders`` -> ``metric_long``.

The scoring job receives its monthly metrics ready-made; this adapter
stands in for that upstream so the engine can run on the driver's test
tables.  Merchant = supplier, month = ship month.  Amounts are exact
decimals, so every engine derives the same text.

Per (merchant, month), with ``x = price * (1 - discount)`` per line:

* ``M_SALE_AMOUNT``        sum(x) / 10, 2 places
* ``M_DEAL_CUST_CNT``      distinct orders
* ``M_CUST_ONE_PRICE``     sales per distinct customer, in cents cut down
* ``M_REFUND_RATE``        returned share of sales, hundredths of a percent cut down, with ``%``
* ``M_TOP3_GOODS_REVENUE`` sum of the 3 largest part totals / 10
* ``M_TOP10_CUST_REVENUE`` sum of the 10 largest customer totals / 10

Plan: two scans of lineitem and one join to orders, for the customer id
(broadcast only when the planner's size estimate of orders is under the
threshold, else a shuffle join).  Joined rows are dealt out once by merchant,
month and a salt of the customer; order sums, customer sums, the salt's
totals and its ten largest customers all use that partitioning, so a hot
(supplier, month) is split over ``SALTS`` groups and sends on at most ten
values from each.  Part totals need no join; they are dealt out by merchant,
month and part, and their top list uses ``row_number`` with a limit, which
Spark turns into a per-partition group limit before the shuffle, so a hot
(supplier, month) ships at most three rows per map task.

A task of these deals holds groups, sorts and windows of its rows at once, so
the number of parts follows the lines (``LINES_PER_PART``): a task's memory
stays as it is while the table grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchpulse.schema import (
    CODE,
    CUST_ONE_PRICE,
    DEAL_CUST_CNT,
    KEY,
    METRIC_CODES,
    MONTH,
    REFUND_RATE,
    SALE_AMOUNT,
    TOP3_GOODS_REVENUE,
    TOP10_CUST_REVENUE,
    VALUE,
)

#: Groups into which the customers of a merchant's month are split.
SALTS = 32
#: Lines behind one part of a deal.
LINES_PER_PART = 200_000


def _m10(e: Column) -> Column:
    """Exact tenth of a decimal amount, rounded half-up to cents."""
    return F.round(e.cast("decimal(18,4)") * F.lit(0.1).cast("decimal(2,1)"), 2)


def _units(e: Column) -> Column:
    """A 4-place decimal amount as an integer count of 1/10000."""
    return (e.cast("decimal(18,4)") * F.lit(10000)).cast("bigint")


def _text(e: Column) -> Column:
    return e.cast("decimal(18,2)").cast("string")


def _top_sum(df: DataFrame, item: str, amount: str, n: int, name: str) -> DataFrame:
    w = Window.partitionBy("sk", "ym").orderBy(F.col(amount).desc(), F.col(item))
    return (
        df.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= n)
        .groupBy("sk", "ym")
        .agg(F.sum(amount).alias(name))
    )


def _line_units(price: Column, discount: Column) -> Column:
    """``price * (1 - discount)`` in exact units of 1/10000, as a bigint:
    price in cents times the remaining discount percent.  Sums of these
    stay in fast 64-bit arithmetic; they become decimals only per month."""
    cents = (price.cast("decimal(18,2)") * F.lit(100)).cast("bigint")
    pct = (discount.cast("decimal(4,2)") * F.lit(100)).cast("bigint")
    return cents * (F.lit(100) - pct)


def _from_units(c: str) -> Column:
    return (F.col(c).cast("decimal(20,0)") / F.lit(10000)).cast("decimal(18,4)")


def monthly_metrics(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Wide form: one row per (merchant, month) with the six values as text.

    Line-level work keeps numeric keys (supplier, ``yyyyMM`` as an int) and
    integer amounts; keys and values become text on the month-level rows.
    """
    lines = lineitem.select(
        F.col("l_suppkey").alias("sk"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("ym"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_partkey").alias("pk"),
        (F.col("l_returnflag") == "R").alias("is_r"),
        _line_units(F.col("l_extendedprice"), F.col("l_discount")).alias("x"),
    )
    parts = max(2, -(-lineitem.count() // LINES_PER_PART))  # one part would need no shuffle, nor a limit before it
    joined = lines.repartition(parts, "ok").join(
        orders.select(F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("ck")), "ok"
    )
    dealt = joined.withColumn("salt", F.pmod(F.xxhash64("ck"), F.lit(SALTS))).repartition(parts, "sk", "ym", "salt")
    by_order = dealt.groupBy("sk", "ym", "salt", "ck", "ok").agg(
        F.sum("x").alias("ox"), F.sum(F.when(F.col("is_r"), F.col("x")).otherwise(F.lit(0))).alias("orx")
    )
    by_cust = by_order.groupBy("sk", "ym", "salt", "ck").agg(
        F.sum("ox").alias("cx"), F.sum("orx").alias("crx"), F.count(F.lit(1)).alias("n_orders")
    )
    largest = Window.partitionBy("sk", "ym", "salt").orderBy(F.col("cx").desc(), "ck")
    by_salt = (
        by_cust.withColumn("rn", F.row_number().over(largest))
        .groupBy("sk", "ym", "salt")
        .agg(
            F.sum("cx").alias("sx"),
            F.sum("crx").alias("rx"),
            F.sum("n_orders").alias("deals"),
            F.count(F.lit(1)).alias("n_cust"),
            F.collect_list(F.when(F.col("rn") <= 10, F.col("cx"))).alias("top"),
        )
    )
    month = (
        by_salt.groupBy("sk", "ym")
        .agg(
            F.sum("sx").alias("sx"),
            F.sum("rx").alias("rx"),
            F.sum("deals").alias("deals"),
            F.sum("n_cust").alias("n_cust"),
            F.flatten(F.collect_list("top")).alias("top"),
        )
        .withColumn("t10", F.aggregate(F.slice(F.sort_array("top", asc=False), 1, 10), F.lit(0).cast("bigint"),
                                       lambda total, x: total + x))
        .drop("top")
    )
    by_part = lines.repartition(parts, "sk", "ym", "pk").groupBy("sk", "ym", "pk").agg(F.sum("x").alias("px"))
    top3 = _top_sum(by_part, "pk", "px", 3, "t3")
    m = (
        month.join(top3, ["sk", "ym"], "left")
        .select(
            F.col("sk").cast("string").alias(KEY),
            F.col("ym").cast("string").alias(MONTH),
            _from_units("sx").alias("sx"),
            _from_units("rx").alias("rx"),
            "deals",
            "n_cust",
            _from_units("t3").alias("t3"),
            _from_units("t10").alias("t10"),
        )
    )
    units = _units(F.col("sx"))
    cents = F.expr(f"{_units_sql('sx')} div (1000 * n_cust)")
    hundredths = F.expr(f"{_units_sql('rx')} * 10000 div {_units_sql('sx')}")
    return m.select(
        KEY,
        MONTH,
        _text(_m10(F.col("sx"))).alias(SALE_AMOUNT),
        F.col("deals").cast("string").alias(DEAL_CUST_CNT),
        _text(cents * F.lit(0.01).cast("decimal(3,2)")).alias(CUST_ONE_PRICE),
        F.when(units > 0, F.concat(_text(hundredths * F.lit(0.01).cast("decimal(3,2)")), F.lit("%"))).alias(
            REFUND_RATE
        ),
        _text(_m10(F.col("t3"))).alias(TOP3_GOODS_REVENUE),
        _text(_m10(F.col("t10"))).alias(TOP10_CUST_REVENUE),
    )


def _units_sql(c: str) -> str:
    return f"cast(cast({c} as decimal(18,4)) * 10000 as bigint)"


def metric_long(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Tall form ``(property_uuid, target_time, metric_dim_code, metric_value)``."""
    wide = monthly_metrics(lineitem, orders)
    return wide.unpivot([KEY, MONTH], list(METRIC_CODES), CODE, VALUE).where(F.col(VALUE).isNotNull())


def load_metric_long(spark, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return metric_long(lineitem, orders)


def uneven(metrics: DataFrame, conflicts: bool = True) -> DataFrame:
    """The metric table made uneven, for checks of what clean data never
    reaches.  Every row takes part; ``d`` is the last digit of the merchant's
    key, ``v`` the row's value text.

    * scale: amounts (sales, top lists) get five places and ``(d + 1) / 10`` of
      their value, top lists ``(10 - d) / 10`` of that, window sales of June
      five times it where d > 6, sales of 1999 three times it where d is 2 or 3;
      unit prices of May six times their value where d > 5; deals times
      ``9 * d * d``; refund rates ``(d + 1) / 10`` of their value
    * absent: rows whose number ends in 3; deals where d = 0, top-10 sums where
      d = 4, refunds where d = 5, sales where d = 6
    * repeated: numbers ending in 2; spelled once more with a further 0: amounts
      whose number ends in 0
    * conflicting (``conflicts``): a second sales value, 0.12345 larger, where
      the number ends in 1
    * bad: a further ``n/a`` row where the number ends in 9, and a null one for
      unit prices whose number ends in 8
    """
    code, month = F.col(CODE), F.col(MONTH)
    number = F.regexp_replace(VALUE, "%", "")
    last = F.right(number, F.lit(1))
    d = F.right(F.col(KEY), F.lit(1)).cast("bigint")
    top = code.isin(TOP3_GOODS_REVENUE, TOP10_CUST_REVENUE)
    cents = F.when(code != DEAL_CUST_CNT, (number.cast("decimal(18,2)") * 100).cast("bigint"))
    factor = (
        F.when(top, 10 - d)
        .when((month == "200006") & (d > 6), F.lit(50))
        .when(month.startswith("1999") & d.isin(2, 3), F.lit(30))
        .otherwise(F.lit(10))
    )
    amount = cents * (d + 1) * factor * 10

    def places5(units: Column) -> Column:
        return (units.cast("decimal(18,0)") * F.lit(0.00001).cast("decimal(5,5)")).cast("decimal(18,5)").cast("string")

    price = cents * F.when((F.substring(month, 5, 2) == "05") & (d > 5), F.lit(6)).otherwise(F.lit(1))
    text = (
        F.when(code == DEAL_CUST_CNT, (number.cast("bigint") * 9 * d * d).cast("string"))
        .when(code == CUST_ONE_PRICE, places5(price * 1000))
        .when(code == REFUND_RATE, F.concat(places5(cents * (d + 1) * 100), F.lit("%")))
        .otherwise(places5(amount))
    )
    is_amount = top | (code == SALE_AMOUNT)
    absent = (
        ((code == DEAL_CUST_CNT) & (d == 0))
        | ((code == TOP10_CUST_REVENUE) & (d == 4))
        | ((code == REFUND_RATE) & (d == 5))
        | ((code == SALE_AMOUNT) & (d == 6))
    )
    rows = [
        (F.lit(True), text),
        (last == "2", text),
        (is_amount & (last == "0"), F.concat(text, F.lit("0"))),
        (F.lit(conflicts) & (code == SALE_AMOUNT) & (last == "1"), places5(amount + 12345)),
        (last == "9", F.lit("n/a")),
        ((code == CUST_ONE_PRICE) & (last == "8"), F.lit(None).cast("string")),
    ]
    made = F.array(*[F.struct(keep.alias("keep"), value.alias("value")) for keep, value in rows])
    return (
        metrics.where((last != "3") & ~absent)
        .select(KEY, MONTH, CODE, F.explode(made).alias("made"))
        .where("made.keep")
        .select(KEY, MONTH, CODE, F.col("made.value").alias(VALUE))
    )
