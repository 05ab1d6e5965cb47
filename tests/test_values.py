"""Values that decimals would cut, rejects, message types and text ends."""

import datetime as dt
import json
import math
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchpulse.__main__ import main
from merchpulse.operators.merge import cogroup_frames, cogroup_values, first_or_default
from merchpulse.plans.job import score_all
from merchpulse.plans.periods import periods
from merchpulse.sinks.messages import quota_json
from merchpulse.sinks.text import output_paths
from merchpulse.sources.text import read_whole_text
from tests.model import model_quotas

AS_OF = "2016-07-15"
MONTHS = periods(AS_OF).months
SCHEMA = "property_uuid string, target_time string, metric_dim_code string, metric_value string"
CASES = {
    "const": ("M_CUST_ONE_PRICE", ["1.23456"] * 6, 0.0),
    "four": ("M_CUST_ONE_PRICE", ["0.0010", "0.0011", "0.0012", "0.0013"], 11.23),
    "huge": ("M_SALE_AMOUNT", ["1e17", "2e17", "3e17"], 50.0),
    "tiny": ("M_SALE_AMOUNT", ["1e-7", "2e-7", "3e-7"], 50.0),
}


@pytest.mark.parametrize("strategy", ["hybrid", "general", "single_pass"])
def test_any_finite_value(spark, strategy):
    rows = [(k, m, code, v) for k, (code, vs, _) in CASES.items() for m, v in zip(MONTHS, vs)]
    got = {r.property_uuid: r for r in score_all(spark.createDataFrame(rows, SCHEMA), AS_OF, strategy=strategy).quotas.collect()}
    want = model_quotas(rows, AS_OF)
    for k, (code, vs, cv) in CASES.items():
        r = got[k]
        assert not any(isinstance(x, float) and not math.isfinite(x) for x in r)
        value = r.cust_price_cv if code == "M_CUST_ONE_PRICE" else r.sale_amount_cv
        assert value == pytest.approx(cv, abs=0.011)
        for a, b in zip(tuple(r)[1:], want[k]):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=0.011))


def test_rejects_are_written(spark, tmp_path):
    rows = [("A", m, "M_SALE_AMOUNT", "100") for m in MONTHS[:5]] + [("A", MONTHS[5], "M_SALE_AMOUNT", "bad")]
    src, out = str(tmp_path / "metrics"), str(tmp_path / "out")
    spark.createDataFrame(rows, SCHEMA).write.parquet(src)
    run = main(["--metrics", src, "--as-of", AS_OF, "--out", out, "--on-bad", "quarantine"], spark=spark)
    assert [r.metric_value for r in run.rejects.collect()] == ["bad"]
    lines = spark.read.text(output_paths(out, AS_OF)["rejects"]).collect()
    assert len(lines) == 1 and "unparsable value" in lines[0].value


def test_json_keeps_integers(spark):
    rows = [("A", MONTHS[0], "M_DEAL_CUST_CNT", "18000")]
    text = quota_json(score_all(spark.createDataFrame(rows, SCHEMA), AS_OF).quotas, AS_OF).first().json
    items = {i["quotaCode"]: i["quotaValue"] for i in json.loads(text)["quotaItemList"]}
    assert '"quotaValue":3000}' in text and items["avg_deal_cnt"] == 3000 and items["refund_rate"] is None


def test_cogroup_keeps_types(spark):
    a = spark.createDataFrame([("k", Decimal("9.00")), ("k", Decimal("10.00"))], "property_uuid string, value decimal(10,2)")
    b = spark.createDataFrame([("k", dt.date(2020, 1, 2)), ("j", dt.date(1999, 1, 1))], "property_uuid string, value date")
    rows = {r.property_uuid: r for r in cogroup_frames([a, b], counts=True).collect()}
    assert rows["k"].v0 == Decimal("9.00") and rows["k"].v0_count == 2 and rows["k"].v1 == dt.date(2020, 1, 2)
    assert rows["j"].v0 is None
    assert cogroup_values([a, b]).count() == 4


def test_first_skips_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (2, 4)], "o int, v int")
    assert df.agg(first_or_default(F.col("v"), -1, F.col("o")).alias("x")).first().x == 4
    assert df.where("v is null").agg(first_or_default(F.col("v"), -1, F.col("o")).alias("x")).first().x == -1


def test_whole_text_line_ends(spark, tmp_path):
    for name, raw in (("a", b"a\n\n"), ("b", b"a\r\nb\r\n"), ("c", b"a")):
        (tmp_path / name).write_bytes(raw)
    got = {os.path.basename(r.path): r.value for r in read_whole_text(spark, str(tmp_path)).collect()}
    assert got == {"a": "a\n", "b": "a\nb", "c": "a"}


def test_paths_need_a_date():
    with pytest.raises(ValueError):
        output_paths("/x", None)
