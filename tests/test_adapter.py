"""The adapter's deals follow the number of lines, and give the same rows however many parts there are."""

import re
from datetime import date
from decimal import Decimal

from merchpulse.sources import adapter


def tables(spark):
    lines = [
        (o, o % 7, o % 3, date(2000, 1 + o % 2, 5), "R" if o % 5 == 0 else "N", Decimal(100 + o) / 4, Decimal(o % 9) / 100)
        for o in range(1, 501)
    ]
    lineitem = spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate date, l_returnflag string,"
        " l_extendedprice decimal(15,2), l_discount decimal(15,2)",
    )
    orders = spark.createDataFrame([(o, o % 11) for o in range(1, 501)], "o_orderkey long, o_custkey long")
    return lineitem, orders


def test_parts_follow_the_lines(spark, monkeypatch):
    lineitem, orders = tables(spark)
    few = adapter.metric_long(lineitem, orders)
    monkeypatch.setattr(adapter, "LINES_PER_PART", 20, raising=False)
    many = adapter.metric_long(lineitem, orders)
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    deals = re.findall(r"RepartitionByExpression \[[^\]]*\], (\d+)", plan)
    assert deals.count("25") >= 3 and set(deals) == {"25"}
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
