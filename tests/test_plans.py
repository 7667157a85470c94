"""Plan checks: the physical plans are the ones intended for scale."""

import contextlib
import os

from pyspark.sql import functions as F

from ledgerline.operators import clean, load, reports
from ledgerline.schemas import TABLES
from ledgerline.sources.testdata import shop_tables
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    """The plan that ran: the action is on ``df`` itself, so its own adaptive plan is final."""
    df.collect()
    plan = _plan(df)
    assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


@contextlib.contextmanager
def _conf(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: static broadcasts off: only what AQE measures at run time, or an operator's checked hint, can broadcast
LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB"}


def _loaded(spark, tmp_dir, table, df):
    path = os.path.join(tmp_dir, table)
    load.load_table(spark, clean.add_audit_columns(df, table, "2024-01-01 00:00:00"), table, path)
    return load.read_target(spark, path, TABLES[table])


def test_cohort_plan_has_no_expand(spark):
    t = shop_tables(spark, SF_SMALL)
    assert "Expand" not in _plan(reports.cohort_retention(t.orders))


def test_channel_and_segments_have_no_expand(spark):
    t = shop_tables(spark, SF_SMALL)
    assert "Expand" not in _plan(
        reports.visitor_segments(t.website_sessions, t.orders).select("customer_type")
    )


def test_since_filter_and_pruning_reach_the_scan(spark, tmp_dir):
    t = shop_tables(spark, SF_SMALL)
    sessions = _loaded(spark, tmp_dir, "website_sessions", t.website_sessions)
    orders = _loaded(spark, tmp_dir, "orders", t.orders)
    df = reports.visitor_segments(sessions, orders, since="1996-01-01")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(created_at), GreaterThanOrEqual(created_at" in plan
    scan = [line for line in plan.splitlines() if "ReadSchema" in line and "is_repeat_session" in line]
    assert scan and "utm_content" not in scan[0] and "http_referer" not in scan[0]


def test_refund_trends_broadcasts_small_products(spark, tmp_dir):
    t = shop_tables(spark, SF_SMALL)
    items = _loaded(spark, tmp_dir, "order_items", t.order_items)
    refunds = _loaded(spark, tmp_dir, "order_item_refunds", t.order_item_refunds)
    products = _loaded(spark, tmp_dir, "products", t.products)
    with _conf(spark, **LARGE):
        df = reports.refund_rate_trends(items, refunds, products, since="1996-01-01")
        assert "BroadcastHashJoin" in _final_plan(df)


def test_orders_only_columns_skip_lineitem(spark):
    t = shop_tables(spark, SF_SMALL)
    plan = _plan(t.orders.select("order_id", "user_id", F.col("price_usd")))
    assert "lineitem" not in plan and "Exchange" not in plan


def test_small_increment_does_not_shuffle_the_target(spark, tmp_dir):
    t = shop_tables(spark, SF_SMALL)
    target = _loaded(spark, tmp_dir, "orders", t.orders)
    increment = clean.add_audit_columns(
        t.orders.filter(F.col("order_id") < 100), "orders", "2024-01-02 00:00:00"
    )
    stored = os.path.join(tmp_dir, "increment")
    increment.write.parquet(stored)
    with _conf(spark, **LARGE):
        df = load.anti_existing(spark.read.parquet(stored), target, "order_id")
        plan = _final_plan(df)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "LeftAnti" in plan
    # nothing is shuffled, the target's key column alone is read, and the key bounds reach its scan
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    scan = [x for x in plan.splitlines() if "FileScan parquet" in x and "ReadSchema: struct<order_id:bigint>" in x and "GreaterThanOrEqual(order_id" in x]
    assert scan and "LessThanOrEqual(order_id" in scan[0]


def test_large_increment_is_never_broadcast(spark, tmp_dir, monkeypatch):
    """Above the bound no key is gathered in the driver, however small Spark takes the key columns to be; null keys and
    repeated ones stay as they are."""
    monkeypatch.setattr(load, "MAX_BROADCAST_KEYS", 3)
    target, stored = os.path.join(tmp_dir, "target"), os.path.join(tmp_dir, "increment")
    spark.range(50).selectExpr("id % 40 AS order_id").write.parquet(target)
    spark.range(30, 60).selectExpr("nullif(id, 59) AS order_id", "'x' AS more").unionAll(spark.sql("SELECT 45L, 'y'")).write.parquet(stored)
    with _conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "10m"}):
        df = load.anti_existing(spark.read.parquet(stored), spark.read.parquet(target), "order_id")
        plan = _final_plan(df)
        got = sorted((r.order_id or 0, r.more) for r in df.collect())
    assert "Broadcast" not in plan and "SortMergeJoin" in plan and "LeftAnti" in plan
    assert got == sorted([(0, "x"), (45, "y"), *((k, "x") for k in range(40, 59))])


def test_incremental_run_moves_full_rows_only_above_the_mark(spark, tmp_dir):
    """Shuffled bytes of a run over loaded history: narrow rows only."""
    from ledgerline.plans.pipeline import stage_clean_table
    from ledgerline.sources import csv as csv_source

    path = os.path.join(tmp_dir, "orders.csv")
    with open(path, "w") as fh:
        fh.write("order_id,created_at,price_usd\n")
        fh.writelines(f"{i},2012-01-01 00:00:{i % 60:02d},{i}.00\n" for i in range(1, 2001))
    raw = csv_source.read_csv(spark, path, with_order=True)
    out = os.path.join(tmp_dir, "staged")
    counts = stage_clean_table(spark, raw, "orders", out, "2024-01-01 00:00:00", "2012-01-01 00:00:58")
    assert counts.rows_clean == 2000 and counts.duplicate_pks == 0
    assert spark.read.parquet(out).count() == sum(1 for i in range(1, 2001) if i % 60 == 59)


def test_exchange_budget_without_broadcasts(spark, tmp_dir):
    """With broadcasts off (the shape on a large cluster), the session-anchored
    reports and the cohort report shuffle exactly three times."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        t = shop_tables(spark, SF_SMALL)
        s = _loaded(spark, tmp_dir, "website_sessions", t.website_sessions)
        o = _loaded(spark, tmp_dir, "orders", t.orders)
        for df in (
            reports.visitor_segments(s, o),  # orders by session, sessions, segments
            reports.revenue_per_session(s, o),
            reports.cohort_retention(o),  # (user, month), user window, cohort
        ):
            assert _plan(df).count("Exchange ") == 3
        # the period's session ids twice (semi-join, join), orders, the total; AQE reuses the second
        assert _plan(reports.conversion_for_period(s, o)).count("Exchange ") <= 4
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
