import datetime as dt

from pyspark.sql import functions as F

from merchpulse.functions import calendar as cal
from merchpulse.functions import text as txt
from merchpulse.functions import textdates as td
from merchpulse.functions.numeric import retain_decimal


def test_retain_decimal_half_up(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (4999.995,), (2.675,)], "x double")
    assert [r[0] for r in df.select(retain_decimal(F.col("x"))).collect()] == [1.01, 0.13, 5000.0, 2.68]


def test_calendar(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2016, 3, 31, 10, 30),), (dt.datetime(2016, 2, 29, 8, 0),), (dt.datetime(2015, 11, 15, 23, 59),)],
        "ts timestamp_ntz",
    )
    got = df.select(
        cal.months_ago("ts", 1, "yyyyMM").alias("m"),
        cal.year_ago("ts", 1).alias("y"),
        cal.months_ago_with_max_day("ts", 1).alias("me"),
        *[c.alias(n) for c, n in zip(cal.week_bounds("ts", 0), ("wb", "we"))],
        cal.quarter_start("ts", "yyyy-MM-dd HH:mm").alias("q"),
        cal.days_in_month("ts").alias("dim"),
        cal.days_ago("ts", 1).alias("d1"),
    ).collect()
    assert got[0].m == "201602" and got[0].me == "2016-02-29" and got[0].q == "2016-01-01 10:30"
    assert got[1].y == "2015-02-28" and got[1].dim == 29 and got[1].d1 == "2016-02-28"
    # a Sunday belongs to the week that began the Monday before
    assert (got[2].wb, got[2].we) == ("2015-11-09", "2015-11-15")
    assert got[2].q == "2015-10-01 23:59"


def test_millis_to_text(spark):
    df = spark.createDataFrame([(1449878400000,)], "ms long")
    assert df.select(cal.millis_to_text("ms", "yyyy-MM-dd")).first()[0] == "2015-12-12"


def test_date_text(spark):
    df = spark.createDataFrame(
        [("paid on 2015/4/3 by card",), ("due 2015-04-30",), ("no date here",), ("month 2015-4 only",),
         ("bad 2015-13-40",)], "s string")
    got = df.select(
        td.cut_year_month_day("s").alias("ymd"),
        td.cut_year_month("s").alias("ym"),
        td.reformat_date_text(td.normalise_separators(td.cut_year_month_day("s")), "yyyy-M-d", "yyyyMMdd").alias("k"),
    ).collect()
    assert [(r.ymd, r.ym, r.k) for r in got] == [
        ("2015/4/3", "2015/4", "20150403"),
        ("2015-04-30", "2015-04", "20150430"),
        ("", "", None),
        ("", "2015-4", None),
        ("2015-13-40", "2015-13", None),
    ]


def test_java_trim(spark):
    df = spark.createDataFrame([("\t a b \n", ["  x", "y\t", " "])], "s string, arr array<string>")
    r = df.select(txt.java_trim("s").alias("s"), txt.trim_array("arr").alias("arr"),
                  txt.strip_percent(F.lit("5%%")).alias("p")).first()
    assert (r.s, r.arr, r.p) == ("a b", ["x", "y", ""], "5")
    row = txt.trim_row(spark.createDataFrame([(" 1 ", 2)], "a string, b int")).first()
    assert (row.a, row.b) == ("1", "2")
