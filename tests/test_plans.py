"""Plan-shape checks: the properties the design relies on at scale."""

import re

from merchpulse.operators.slices import base_values
from merchpulse.plans import single_pass
from merchpulse.plans.periods import periods
from merchpulse.sources.adapter import load_metric_long

from tests.fixture import AS_OF, metrics_frame


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_pass_is_two_partial_aggregated_shuffles(spark, tmp_path):
    path = str(tmp_path / "m")
    metrics_frame(spark).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        q = single_pass.all_quotas(base_values(spark.read.parquet(path), periods(AS_OF)), periods(AS_OF))
        plan = _plan(q)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = re.findall(r"Exchange (\w+)", plan)
    assert exchanges == ["hashpartitioning", "hashpartitioning"], exchanges
    assert "BroadcastExchange" not in plan
    # each shuffle is fed directly by a map-side (partial) aggregate
    lines = plan.splitlines()
    children = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(children) == 2 and all("HashAggregate" in c for c in children), children


def test_adapter_part_list_limits_before_the_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(load_metric_long(spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # top-3 parts: a partial group limit under the window's shuffle
    assert plan.count("WindowGroupLimit") >= 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_adapter_joins_orders_once(spark):
    """Without broadcasts: one scan of orders, two of lineitem, and joined rows
    are dealt out once for the order, customer and salt groups."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(load_metric_long(spark, "/root/testdata/sf0.001"))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert sum("o_orderkey" in ln for ln in scans) == 1 and sum("l_suppkey" in ln for ln in scans) == 2, scans
    # the join's two sides, the salted groups, the months; parts, their top list, its months are at most three more
    assert plan.count("Exchange hashpartitioning") <= 7, plan


def test_month_window_reaches_line_items(spark):
    from merchpulse.queries import P

    base = base_values(load_metric_long(spark, "/root/testdata/sf0.001"), P)
    optimized = base._jdf.queryExecution().optimizedPlan().toString()
    line_filters = [ln for ln in optimized.splitlines() if "Filter" in ln and "l_shipdate" in ln]
    assert line_filters and any(P.ye_start in ln and P.end in ln for ln in line_filters), line_filters
