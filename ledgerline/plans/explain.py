"""Plan summary of every report, in the shape a large cluster runs it.

    python -m ledgerline.plans.explain [sf_dir] > PLANS.md

The raw tables are first loaded to Parquet (so scans, pushed filters and read
schemas are those of real targets), broadcasts are switched off (large
inputs never qualify), and each report's physical plan is summarised: shuffle
exchanges, join strategies, aggregations, windows, ``Expand`` and what
reaches the scans.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import DataFrame

from ledgerline.operators import clean, load, reports
from ledgerline.schemas import TABLES
from ledgerline.session import build_session, scratch_path
from ledgerline.sources.testdata import shop_tables


def summarize(df: DataFrame) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()

    def count(pattern: str) -> int:
        return sum(1 for line in lines if re.search(pattern, line))

    exchanges = [re.sub(r"#\d+L?", "", m) for m in re.findall(r"Exchange (\w+\([^)]*\)|SinglePartition)", plan)]
    scans = []
    for line in lines:
        if "FileScan parquet" in line:
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            scans.append(
                (
                    re.sub(r"#\d+L?", "", pushed.group(1)) if pushed else "",
                    schema.group(1) if schema else "",
                )
            )
    return {
        "exchanges": exchanges,
        "sort_merge_joins": count(r"SortMergeJoin"),
        "broadcast_joins": count(r"BroadcastHashJoin"),
        "hash_aggregates": count(r"HashAggregate\("),
        "windows": count(r"\bWindow \["),
        "expand": count(r"\bExpand\b"),
        "scans": scans,
    }


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        shuffle_partitions=200,
        extra={
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            # pushed filters and read schemas in full
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
        },
    )
    t = shop_tables(spark, sf_dir)
    folder = scratch_path(spark, "plans")
    raw = {}
    for name in TABLES:
        path = f"{folder}/{name}"
        load.load_table(
            spark, clean.add_audit_columns(t.table(name), name, "2024-01-01 00:00:00"), name, path
        )
        raw[name] = load.read_target(spark, path, TABLES[name])
    s, o = raw["website_sessions"], raw["orders"]
    i, r, p = raw["order_items"], raw["order_item_refunds"], raw["products"]
    since = "1996-01-01"
    cases = {
        "M1 metrics (run once, stored)": lambda: reports.channel_metrics(s, o, since),
        "M1 channel_performance (ranks of the stored metrics)": lambda: reports.channel_performance(s, o, since=since),
        "M2 metrics (run once, stored)": lambda: reports.product_metrics(p, i, r),
        "M2 product_profitability (ranks of the stored metrics)": lambda: reports.product_profitability(p, i, r),
        "M3 refund_rate_trends": lambda: reports.refund_rate_trends(i, r, p, since=since),
        # medians read a stored table of distinct prices by month (one exchange before it)
        "M4 order_value_trends": lambda: reports.order_value_trends(o, s),
        "M4a order_value_trends_orders_only": lambda: reports.order_value_trends_orders_only(o),
        "M4b revenue_per_session": lambda: reports.revenue_per_session(s, o),
        "M5 cohort_retention": lambda: reports.cohort_retention(o),
        "M6 visitor_segments": lambda: reports.visitor_segments(s, o, since=since),
        "M7 conversion_for_period": lambda: reports.conversion_for_period(
            s, o, "1998-04-01", "1998-05-01"
        ),
    }
    print("# Physical plan summaries (broadcasts off, inputs loaded to Parquet)\n")
    print("Generated by `python -m ledgerline.plans.explain`. Exchanges are listed in plan order")
    print("(top = last).\n")
    for title, build in cases.items():
        info = summarize(build())
        print(f"## {title}\n")
        print(f"- exchanges: {len(info['exchanges'])}")
        for e in info["exchanges"]:
            print(f"  - `{e}`")
        print(f"- joins: {info['sort_merge_joins']} sort-merge, {info['broadcast_joins']} broadcast")
        print(f"- hash aggregates: {info['hash_aggregates']}; windows: {info['windows']}; Expand: {info['expand']}")
        for pushed, schema in info["scans"]:
            print(f"- scan: pushed `[{pushed}]`, reads `{schema}`")
        print()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
