import json
import os

from merchpulse.streaming.online import read_requests, score_requests

from tests.fixture import AS_OF, EXPECTED_FINAL, metrics_frame


def test_online_requests_stream(spark, tmp_path):
    req = tmp_path / "requests"
    req.mkdir()
    (req / "a.txt").write_text("A\nC\n\nA\n")
    (req / "b.txt").write_text("H\nZ\n")  # Z has no metrics: no output row
    out = str(tmp_path / "out")
    q = score_requests(read_requests(spark, str(req), max_files_per_trigger=1), metrics_frame(spark), AS_OF, out,
                       str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    batches = sorted(d for d in os.listdir(out) if d.startswith("batch_id="))
    assert len(batches) == 2
    final = {r.property_uuid: r.final_score for r in spark.read.parquet(f"{out}/*/final").collect()}
    assert final == {k: EXPECTED_FINAL[k] for k in ("A", "C", "H")}
    msgs = [json.loads(r.json) for r in spark.read.parquet(f"{out}/*/messages").collect()]
    assert sorted(m["propertyUuid"] for m in msgs) == ["A", "C", "H"]
