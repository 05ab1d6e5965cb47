"""Plan shape and wall time of the full run, per strategy.

    python tools/plan_stats.py [/root/testdata/sf0.1]

Builds the metric table from the test tables into a fresh scratch folder,
then for each strategy reports the wall time of scoring every merchant,
the metric rows the scan passes on after the pushed-down filters, and the
shuffle exchanges of the static physical plan (AQE off for the count; the
jobs that materialise intermediate results are counted separately).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from merchpulse.operators.slices import windowed_rows  # noqa: E402
from merchpulse.plans.job import score_all  # noqa: E402
from merchpulse.plans.periods import periods  # noqa: E402
from merchpulse.queries import AS_OF  # noqa: E402
from merchpulse.session import local_session  # noqa: E402
from merchpulse.sources.adapter import load_metric_long  # noqa: E402


def exchanges(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "broadcast": plan.count("BroadcastExchange"),
        "reused": plan.count("ReusedExchange"),
    }


def main(sf_dir: str) -> None:
    spark = local_session(8)
    path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "metric_long")
    load_metric_long(spark, sf_dir).write.parquet(path)
    metrics = spark.read.parquet(path)
    out = {"sf_dir": sf_dir, "metric_rows": metrics.count(),
           "rows_after_scan_filters": windowed_rows(metrics, periods(AS_OF)).count(), "plans": {}}
    for strategy in ("hybrid", "single_pass", "general"):
        score_all(metrics, AS_OF, strategy=strategy).final.collect()  # warm
        jobs_before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
        t0 = time.perf_counter()
        final = score_all(metrics, AS_OF, strategy=strategy).final
        final.collect()
        wall = time.perf_counter() - t0
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - jobs_before
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        shape = exchanges(score_all(metrics, AS_OF, strategy=strategy, materialize_base="none").quotas) \
            if strategy == "single_pass" else None
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        out["plans"][strategy] = {"wall_sec": round(wall, 2), "spark_jobs": jobs,
                                  **({"exchanges_single_plan": shape} if shape else {})}
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
