import pytest
from pyspark.sql import functions as F

from merchpulse.operators.slices import base_values, metric_slice, parse_rows, windowed_rows
from merchpulse.plans.periods import months_ago, periods
from merchpulse.schema import METRIC_LONG


def test_periods():
    p = periods("2015-12-15")
    assert (p.start, p.end, p.ye_start, p.ye_end) == ("201506", "201511", "201406", "201411")
    assert periods("2000-07-15").months == ("200001", "200002", "200003", "200004", "200005", "200006")
    assert months_ago("2016-03-31", 1) == "201602"
    assert months_ago("2016-01-15", 1) == "201512"


def test_distinct_after_parse(spark):
    rows = [("B", "201508", "M_SALE_AMOUNT", "300"), ("B", "201508", "M_SALE_AMOUNT", "300.0"),
            ("B", "201508", "M_SALE_AMOUNT", "200")]
    df = spark.createDataFrame(rows, METRIC_LONG)
    got = sorted(r.value for r in metric_slice(df, "M_SALE_AMOUNT", "201506", "201511").collect())
    assert got == [200.0, 300.0]


def test_percent_and_int_parse(spark):
    rows = [("A", "201506", "M_REFUND_RATE", "5%"), ("A", "201507", "M_REFUND_RATE", "6.5"),
            ("A", "201506", "M_DEAL_CUST_CNT", "12")]
    df = spark.createDataFrame(rows, METRIC_LONG)
    assert sorted(r.value for r in metric_slice(df, "M_REFUND_RATE", "201506", "201511").collect()) == [5.0, 6.5]
    deals = metric_slice(df, "M_DEAL_CUST_CNT", "201506", "201511").collect()
    assert [r.value for r in deals] == [12]


@pytest.mark.parametrize("bad", [
    ("A", "201510", "M_DEAL_CUST_CNT", "12.0"),   # int code needs an int
    ("A", "201510", "M_SALE_AMOUNT", "abc"),
    ("A", "201510", "M_SALE_AMOUNT", None),
    ("A", "201513", "M_SALE_AMOUNT", "1"),        # not a month; inside the text range
])
def test_bad_rows_fail_by_default(spark, bad):
    p = periods("2016-02-15")
    df = spark.createDataFrame([bad], METRIC_LONG)
    with pytest.raises(Exception, match="bad metric row"):
        base_values(df, p).collect()


def test_bad_rows_quarantine(spark):
    p = periods("2016-02-15")
    rows = [("A", "201509", "M_SALE_AMOUNT", "1"), ("A", "201510", "M_SALE_AMOUNT", "x"),
            ("A", "201510", "M_DEAL_CUST_CNT", "1.5")]
    df = spark.createDataFrame(rows, METRIC_LONG)
    good, bad = parse_rows(windowed_rows(df, p), on_bad="quarantine")
    assert [r.value for r in good.collect()] == [1.0]
    assert sorted(r.reason for r in bad.collect()) == ["unparsable value", "unparsable value"]


def test_scan_filters_reach_parquet(spark, tmp_path):
    rows = [("A", "201506", "M_SALE_AMOUNT", "1"), ("A", "201506", "M_OTHER", "1")]
    path = str(tmp_path / "m")
    spark.createDataFrame(rows, METRIC_LONG).write.parquet(path)
    df = windowed_rows(spark.read.parquet(path), periods("2015-12-15"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "metric_dim_code" in plan.split("PushedFilters")[1]
    assert df.count() == 1


def test_quarantine_run_scores_good_rows_and_returns_rejects(spark):
    from merchpulse.plans.job import score_all
    from tests.fixture import AS_OF, EXPECTED_FINAL, ROWS

    bad = [("A", "201507", "M_DEAL_CUST_CNT", "n/a"), ("Q", "201508", "M_SALE_AMOUNT", None)]
    df = spark.createDataFrame(ROWS + bad, METRIC_LONG)
    with pytest.raises(Exception, match="bad metric row"):
        score_all(df, AS_OF).final.collect()
    run = score_all(df, AS_OF, on_bad="quarantine")
    finals = {r.property_uuid: r.final_score for r in run.final.collect()}
    assert finals["C"] == EXPECTED_FINAL["C"] and "Q" not in finals
    assert sorted((r.property_uuid, r.reason) for r in run.rejects.collect()) == [
        ("A", "unparsable value"), ("Q", "null value")]
