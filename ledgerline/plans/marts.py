"""The staging -> mart DAG as plain function composition, and its
materialisation (staging as temp views, marts as Parquet tables).

One Catalyst plan spans source, staging and mart, so staging costs nothing, and every mart is a lazy plan.
Marts hold a row per channel, product or month: they are written unpartitioned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators import reports
from ledgerline.operators.staging import register_views, stage_all
from ledgerline.sources.files import current_snapshot, delete_path, publish_snapshot, write_snapshot

#: O1: the display order of each mart, as (column, descending); later columns make it total
MART_ORDER = {
    "mrt_channel_performance": [("conversion_rate_pct", True), ("utm_source", False), ("utm_campaign", False)],
    "mrt_product_profitability": [("gross_profit", True), ("product_name", False)],
    "mrt_refund_rate_trends": [("refund_month", True), ("product_name", False)],
    "mrt_order_value_trends": [("month", True)],
    "mrt_cohort_retention": [("cohort_month", True)],
}


def order_of(mart: str) -> list:
    """Sort expressions of a mart; NULLs come first under DESC and last under ASC."""
    return [F.col(c).desc_nulls_first() if down else F.col(c).asc_nulls_last() for c, down in MART_ORDER[mart]]


def in_order(df: DataFrame, mart: str) -> DataFrame:
    """The mart in its display order."""
    return df.orderBy(*order_of(mart))


def with_positions(df: DataFrame, mart: str) -> DataFrame:
    """The mart with its display position (1 ..) as a column. Meant for what is shown: all of a mart's rows
    (channels, products, months) are numbered in one task."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order_of(mart))))


def build_marts(
    raw: dict[str, DataFrame], since: str = reports.DEFAULT_SINCE, min_sessions: int = 100, ordered: bool = False
) -> dict[str, DataFrame]:
    """The five marts over the staging views of ``raw`` (lazy plans), on request in display order."""
    stg = stage_all(raw)
    builders: dict[str, Callable[[], DataFrame]] = {
        "mrt_channel_performance": lambda: reports.channel_performance(
            stg["stg_website_sessions"], stg["stg_orders"], since=since, min_sessions=min_sessions
        ),
        "mrt_product_profitability": lambda: reports.product_profitability(
            stg["stg_products"], stg["stg_order_items"], stg["stg_order_item_refunds"]
        ),
        "mrt_refund_rate_trends": lambda: reports.refund_rate_trends(
            stg["stg_order_items"], stg["stg_order_item_refunds"], stg["stg_products"], since=since
        ),
        "mrt_order_value_trends": lambda: reports.order_value_trends(
            stg["stg_orders"], stg["stg_website_sessions"]
        ),
        "mrt_cohort_retention": lambda: reports.cohort_retention(stg["stg_orders"]),
    }
    return {name: in_order(b(), name) if ordered else b() for name, b in builders.items()}


def materialize(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    out_dir: str,
    since: str = reports.DEFAULT_SINCE,
    min_sessions: int = 100,
    ordered: bool = False,
) -> dict[str, str]:
    """Register staging views and write every mart as a versioned table under ``out_dir``; returns mart -> folder of
    its rows. All marts are written before the first one is published, so a mart that cannot be
    written leaves every mart as it was, and readers (``read_mart``) see a mart's old or new rows in full."""
    register_views(stage_all(raw))
    out_dir = out_dir.rstrip("/")
    written: dict[str, str] = {}
    try:
        for name, df in build_marts(raw, since, min_sessions, ordered).items():
            written[name] = write_snapshot(df, f"{out_dir}/{name}")
    except BaseException:
        for snapshot in written.values():
            delete_path(spark, snapshot)
        raise
    for name, snapshot in written.items():
        publish_snapshot(spark, f"{out_dir}/{name}", snapshot)
    return written


def read_mart(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The current rows of a materialised mart."""
    return spark.read.parquet(current_snapshot(spark, f"{out_dir.rstrip('/')}/{name}"))


def register_all(
    raw: dict[str, DataFrame],
    since: str = reports.DEFAULT_SINCE,
    min_sessions: int = 100,
) -> list[str]:
    """Expose raw tables (their own names), staging (``stg_*``) and marts
    (``mrt_*``) as temp views, so ad-hoc SQL runs with ``spark.sql``. The
    views are lazy: a query over a mart runs the mart's plan."""
    views = dict(raw)
    views.update(stage_all(raw))
    views.update(build_marts(raw, since, min_sessions))
    register_views(views)
    return sorted(views)
