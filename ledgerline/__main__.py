"""Command line: the scripts a user of the reference runs, on Spark.

    python -m ledgerline load   <landing_dir> <warehouse_dir> [--serial]
    python -m ledgerline verify <warehouse_dir> [--period 2012-04-01 2012-05-01]
    python -m ledgerline marts  <warehouse_dir> <marts_dir> [--since 2013-01-01]

Every command prints DataFrames produced by the library's operators; the
work runs on whatever cluster the session is submitted to (``spark-submit
-m ledgerline ...`` or a ``SPARK_MASTER`` / builder default).
"""

from __future__ import annotations

import argparse
import os
import sys

from ledgerline.operators import quality, reports
from ledgerline.plans.marts import materialize
from ledgerline.plans.pipeline import read_loaded, run_pipeline
from ledgerline.session import build_session


def _session(shuffle: int):
    return build_session(
        master=os.environ.get("SPARK_MASTER", "local[*]"),
        app_name="ledgerline-cli",
        shuffle_partitions=shuffle,
    )


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerline")
    ap.add_argument("--shuffle-partitions", type=int, default=200)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p_load = sub.add_parser("load", help="extract -> clean -> validate -> load every table")
    p_load.add_argument("landing")
    p_load.add_argument("warehouse")
    p_load.add_argument("--multiline", action="store_true", help="quoted fields may span lines")
    p_load.add_argument("--malformed", choices=["fail", "count"], default="fail", help="rows with surplus fields")
    p_load.add_argument("--on-bad-value", choices=["keep", "fail"], default="keep", help="unparseable keys and money")
    p_load.add_argument("--serial", action="store_true", help="one table at a time")
    p_ver = sub.add_parser("verify", help="post-load checks")
    p_ver.add_argument("warehouse")
    p_ver.add_argument("--period", nargs=2, default=list(reports.DEFAULT_PERIOD))
    p_mart = sub.add_parser("marts", help="build the five marts as tables")
    p_mart.add_argument("warehouse")
    p_mart.add_argument("out")
    p_mart.add_argument("--since", default=reports.DEFAULT_SINCE)
    p_mart.add_argument("--ordered", action="store_true", help="write each mart in its display order")
    args = ap.parse_args(argv)

    spark = _session(args.shuffle_partitions)
    if args.cmd == "load":
        summary = run_pipeline(
            spark,
            args.landing,
            args.warehouse,
            parallel_tables=1 if args.serial else 3,
            malformed=args.malformed,
            on_bad_value=args.on_bad_value,
            multiline=args.multiline,
        )
        summary.show(truncate=False)
        failed = summary.filter("status = 'failed'").count()
        return 1 if failed else 0
    tables = read_loaded(spark, args.warehouse)
    if args.cmd == "verify":
        quality.profiles(tables).show(truncate=False)  # row counts, NULL keys, date ranges
        if "orders" in tables:
            quality.sample_rows(tables["orders"]).show(truncate=False)
        if {"website_sessions", "orders"} <= set(tables):
            reports.conversion_for_period(
                tables["website_sessions"], tables["orders"], *args.period
            ).show(truncate=False)
        return 0
    paths = materialize(spark, tables, args.out, since=args.since, ordered=args.ordered)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
