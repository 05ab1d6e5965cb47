"""Shared slices, rejects in one pass, outputs published together, batches of
merchants and numbered lines."""

import os

import pytest
from pyspark.sql import functions as F

from merchpulse.__main__ import main
from merchpulse.operators import quotas
from merchpulse.operators.slices import base_values, shared_slices, split_rows
from merchpulse.plans.job import of_merchants, run_and_write, run_and_write_many, score_all
from merchpulse.plans.periods import periods
from merchpulse.schema import QUOTAS
from merchpulse.sinks.publish import Publication, published
from merchpulse.sinks.text import online_root, output_paths, write_rows
from merchpulse.sources.text import read_numbered_lines
from tests.fixture import AS_OF, EXPECTED_QUOTAS, ROWS, metrics_frame

P = periods(AS_OF)
BAD = [("A", "201507", "M_SALE_AMOUNT", None), ("B", "20150701", "M_SALE_AMOUNT", "1"), ("B", "201507", "M_DEAL_CUST_CNT", "1.5"),
       ("Z", "201507", "M_SALE_AMOUNT", "NaN"), ("Z", "201507", "M_SALE_AMOUNT", "NaN")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_slices_read_their_code_alone(spark):
    base = base_values(metrics_frame(spark), P)
    table = shared_slices(base)
    assert sorted(map(tuple, table.frame.collect())) == sorted(map(tuple, base.collect()))
    plan = _plan(quotas.code_slice(table.frame, "M_DEAL_CUST_CNT", P))
    assert "PartitionFilters: [isnotnull(metric_dim_code" in plan and "PushedFilters: [IsNotNull(target_time)" in plan
    assert "ReadSchema: struct<property_uuid:string,target_time:string,value:double>" in plan
    folder = table.path.removeprefix("file:")
    assert os.path.isdir(folder)
    table.drop()
    assert not os.path.exists(folder)


def test_good_and_rejected_rows_from_one_scan(spark, tmp_path):
    src = str(tmp_path / "metrics")
    metrics_frame(spark, ROWS + BAD).write.parquet(src)
    base, rejects, counts, table = split_rows(spark.read.parquet(src), P)
    assert counts == {"null value": 1, "bad month": 1, "unparsable value": 1, "non-finite value": 2}
    assert sorted((r.property_uuid, r.reason) for r in rejects.collect()) == [
        ("A", "null value"), ("B", "bad month"), ("B", "unparsable value"), ("Z", "non-finite value"), ("Z", "non-finite value")]
    assert src not in _plan(base) and src not in _plan(rejects)  # both read what the one pass wrote
    assert "PartitionFilters: [isnotnull(outcome" in _plan(base)
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, base_values(metrics_frame(spark, ROWS), P).collect()))
    table.drop()
    run = score_all(metrics_frame(spark, ROWS + BAD), AS_OF, on_bad="quarantine")
    assert {r.property_uuid: tuple(r[q] for q in QUOTAS) for r in run.quotas.collect()} == EXPECTED_QUOTAS
    assert sum(run.reject_counts.values()) == 5 and len(run.tables) == 1
    run.drop()


def _lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def test_outputs_are_published_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    one, two = spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("b", 2)], "k string, v int")

    def run(frames):
        with Publication(spark, root) as out:
            for name, df in frames.items():
                write_rows(df, out.path(name))

    run({"x": one, "y": one, "rejects": one})
    first = published(spark, root)
    assert set(first["outputs"]) == {"x", "y", "rejects"} and first["outputs"]["x"]["bytes"] > 0
    bad = one.select("k", F.raise_error(F.lit("no")).cast("int").alias("v"))
    with pytest.raises(Exception, match="no"):
        run({"x": two, "y": bad})
    assert _lines(spark, f"{root}/x") == _lines(spark, f"{root}/y") == ["a\t1"] and published(spark, root) == first
    # a move that fails takes back those before it
    moves, move = [], Publication._move

    def failing(self, source, target):
        moves.append(target)
        if len(moves) == 4:
            raise OSError("no move")
        move(self, source, target)

    monkeypatch.setattr(Publication, "_move", failing)
    with pytest.raises(OSError):
        run({"x": two, "y": two})
    monkeypatch.undo()
    assert _lines(spark, f"{root}/x") == _lines(spark, f"{root}/y") == ["a\t1"] and published(spark, root) == first
    run({"x": two, "y": two})
    assert _lines(spark, f"{root}/x") == ["b\t2"] and not os.path.exists(f"{root}/rejects")  # of an earlier run
    assert set(published(spark, root)["outputs"]) == {"x", "y"}
    assert sorted(n for n in os.listdir(root) if not n.startswith(".")) == ["_MANIFEST.json", "x", "y"]


def test_a_failed_run_leaves_the_last_outputs(spark, tmp_path):
    base = str(tmp_path)
    run_and_write(metrics_frame(spark), AS_OF, base)
    paths = output_paths(base, AS_OF)
    before = _lines(spark, paths["finalScores"])
    with pytest.raises(Exception, match="bad metric row"):
        run_and_write(metrics_frame(spark, ROWS + BAD), AS_OF, base)
    assert _lines(spark, paths["finalScores"]) == before
    assert set(published(spark, os.path.dirname(paths["quotas"]))["outputs"]) == {"quotas", "quotaScores", "finalScores"}


def test_a_batch_of_merchants_replaces_its_own_folders(spark, tmp_path):
    src, base = str(tmp_path / "metrics"), str(tmp_path / "out")
    metrics_frame(spark).write.parquet(src)
    metrics = spark.read.parquet(src)
    assert "In(property_uuid, [A,C])" in _plan(of_merchants(metrics, ["A", "C"]))
    many = of_merchants(metrics, [f"k{i}" for i in range(2000)] + ["C"])
    assert "LeftSemi" in _plan(many) and many.select("property_uuid").distinct().collect()[0][0] == "C"
    main(["--metrics", src, "--as-of", AS_OF, "--out", base, "A", "C"], spark=spark)
    root = online_root(base, AS_OF)
    final = lambda: sorted(r.value for r in spark.read.text(f"{root}/finalScores").select("value").collect())
    assert final() == ["A\t73", "C\t39"]
    fewer = metrics.where("property_uuid <> 'C'")
    run = run_and_write_many(fewer, ["C", "D"], AS_OF, base)
    assert [tuple(r) for r in run.final.collect()] == [("D", 10)]
    assert final() == ["A\t73", "D\t10"]  # C has no result any more; A was not asked for


def test_lines_are_numbered_across_splits(spark, tmp_path):
    want = []
    for name, end, n in (("a", "\n", 3000), ("b", "\r\n", 500), ("c", "\n", 0)):
        lines = [f"{name} line {i} " + "x" * (i % 50) for i in range(n)]
        (tmp_path / name).write_bytes(end.join(lines).encode() + (end.encode() if name == "b" else b""))
        want += [(name, i + 1, text) for i, text in enumerate(lines)]
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_numbered_lines(spark, str(tmp_path))
        got = [(os.path.basename(r.path), r.line, r.value) for r in rows.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert sorted(got) == sorted(want)
