import json

from merchpulse.plans.job import run_and_write, score_all
from merchpulse.sinks.messages import quota_json, quota_lines, quota_lines_named, quota_messages
from merchpulse.sinks.text import output_paths, rows_to_lines
from merchpulse.sources.text import read_lines, read_whole_text

from tests.fixture import AS_OF, metrics_frame


def _quotas(spark):
    return score_all(metrics_frame(spark), AS_OF).quotas


def test_row_text(spark):
    lines = {r.value.split("\t")[0]: r.value for r in rows_to_lines(_quotas(spark)).collect()}
    assert lines["C"] == "C\t10000.0\tNone\tNone\tNone\tNone\t100.0\tNone\tNone\tNone\tNone"
    assert lines["A"] == "A\t14500.0\t1008\t5.68\t29.82\t10.13\t28.16\t7.87\t138.1\t116.94\t4"


def test_output_paths():
    p = output_paths("hdfs://nn/base/", "2015-12-15")
    assert p["quotas"] == "hdfs://nn/base/offline/201512/15/quotas"
    p = output_paths("/x", "2015-12-15", uuid="A")
    assert p["finalScores"] == "/x/online/201512/15/A/finalScores"


def test_run_and_write_round_trip(spark, tmp_path):
    run_and_write(metrics_frame(spark), AS_OF, str(tmp_path))
    run_and_write(metrics_frame(spark), AS_OF, str(tmp_path), single_file=True)  # overwrites (K3)
    paths = output_paths(str(tmp_path), AS_OF)
    final = sorted(r.value for r in read_lines(spark, paths["finalScores"]).collect())
    assert final == ["A\t73", "B\t38", "C\t39", "D\t10", "G\t16", "H\t38", "I\t38"]
    whole = read_whole_text(spark, paths["finalScores"]).collect()
    assert len(whole) == 1 and not whole[0].value.endswith("\n") and whole[0].value.count("\n") == 6
    scores = sorted(r.value for r in read_lines(spark, paths["quotaScores"]).collect())
    assert scores[0] == "A\t5\t8\t8\t10\t10\t7\t10\t4\t6\t8"


def test_messages(spark):
    msgs = quota_messages(_quotas(spark), AS_OF, item_name="health")
    lines = sorted(r.value for r in quota_lines(msgs).collect() if r.value.split("\t")[1] == "G")
    assert "health\tG\tavg_deal_cnt\t2\t201512\t3000" in lines
    assert "health\tG\trefund_rate\t2\t201512\tNone" in lines
    named = [r.value for r in quota_lines_named(msgs).collect() if r.value.startswith("G\t")]
    assert "G\thealth\tavg_sale_amount\tmean monthly sales\t2\t201512\t0.0" in named
    assert len(named) == 10


def test_json_envelope(spark):
    rows = {r.property_uuid: json.loads(r.json) for r in quota_json(_quotas(spark), AS_OF).collect()}
    d = rows["D"]
    assert list(d) == ["quotaItemName", "propertyUuid", "quotaItemList"]
    assert [i["quotaCode"] for i in d["quotaItemList"]][:2] == ["avg_sale_amount", "avg_deal_cnt"]
    assert d["quotaItemList"][4] == {"indexFlag": "2", "quotaCode": "cust_price_cv", "targetTime": "201512",
                                     "quotaValue": 70.71}
    assert d["quotaItemList"][0]["quotaValue"] is None
    named = {r.property_uuid: json.loads(r.json) for r in quota_json(_quotas(spark), AS_OF, named=True).collect()}
    assert list(named["D"]["quotaItemList"][0]) == ["indexFlag", "quotaName", "quotaCode", "targetTime",
                                                    "quotaValue"]


def test_command_line(spark, tmp_path):
    from merchpulse.__main__ import main
    from tests.fixture import metrics_frame as mf

    src = str(tmp_path / "metrics")
    mf(spark).write.parquet(src)
    out = str(tmp_path / "out")
    main(["--metrics", src, "--as-of", AS_OF, "--out", out], spark=spark)
    main(["A", "--metrics", src, "--as-of", AS_OF, "--out", out], spark=spark)
    offline = output_paths(out, AS_OF)["finalScores"]
    online = output_paths(out, AS_OF, uuid="A")["finalScores"]
    assert sorted(r.value for r in read_lines(spark, offline).collect())[0] == "A\t73"
    assert [r.value for r in read_lines(spark, online).collect()] == ["A\t73"]
