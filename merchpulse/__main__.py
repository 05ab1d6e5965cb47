"""Command line for a full or one-merchant run.

    python -m merchpulse --metrics PATH --as-of YYYY-MM-DD --out BASE [UUID ...]
    spark-submit --py-files merchpulse.zip merchpulse/__main__.py --metrics ... [UUID ...]

(``merchpulse.zip`` is the zipped package directory.)

Without a merchant key it scores every merchant (offline layout); with one
it scores that merchant (online layout), as the published job's command
line does, and with several these in one run.  The metric table is read from
parquet (``--format`` for other file formats) or, with ``--jdbc-url``, from a
JDBC table or sub-query.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from merchpulse.plans.job import STRATEGIES, run_and_write, run_and_write_many
from merchpulse.sources.metrics import read_jdbc, read_metrics


def parse_args(argv=None):
    ap = argparse.ArgumentParser(prog="merchpulse", description=__doc__.splitlines()[0])
    ap.add_argument("uuid", nargs="*", help="score only this merchant, or these in one run")
    ap.add_argument("--metrics", help="metric table path (or JDBC table / sub-query with --jdbc-url)")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-driver")
    ap.add_argument("--jdbc-partition-column")
    ap.add_argument("--jdbc-lower-bound")
    ap.add_argument("--jdbc-upper-bound")
    ap.add_argument("--jdbc-partitions", type=int)
    ap.add_argument("--as-of", required=True, help="reference date, YYYY-MM-DD")
    ap.add_argument("--out", required=True, help="output base folder")
    ap.add_argument("--strategy", default="hybrid", choices=STRATEGIES)
    ap.add_argument("--bands", default="as_published", choices=("as_published", "by_name"))
    ap.add_argument("--on-bad", default="fail", choices=("fail", "quarantine"))
    ap.add_argument("--single-file", action="store_true", help="one output file per table (coalesce(1))")
    return ap.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None):
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName("merchpulse").getOrCreate()
    if args.jdbc_url:
        metrics = read_jdbc(spark, args.jdbc_url, args.metrics, driver=args.jdbc_driver,
                            partition_column=args.jdbc_partition_column, lower_bound=args.jdbc_lower_bound,
                            upper_bound=args.jdbc_upper_bound, num_partitions=args.jdbc_partitions)
    else:
        metrics = read_metrics(spark, args.metrics, args.format)
    how = {"strategy": args.strategy, "bands": args.bands, "on_bad": args.on_bad}
    if len(args.uuid) > 1:
        return run_and_write_many(metrics, args.uuid, args.as_of, args.out, **how)
    return run_and_write(metrics, args.as_of, args.out, uuid=args.uuid[0] if args.uuid else None, single_file=args.single_file, **how)


if __name__ == "__main__":
    main()
