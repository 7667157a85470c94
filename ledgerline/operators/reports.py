"""Report operators (the marts and the ad-hoc report queries).

Every operator takes DataFrames with the raw/staged column names and keyword
parameters (defaults are the reference's constants) and returns a DataFrame
whose columns are already in final form: counts and ranks ``bigint``, money and
rates ``double`` (computed exactly in decimal, rounded half away from zero),
months ``date``.

Scale notes, shared by all reports:

* Primary keys are unique after loading (validation keeps the first row per
  key, the merge inserts only absent keys). So ``COUNT(DISTINCT pk)`` is a
  plain ``count(pk)`` and needs no distinct aggregation (no ``Expand``, no
  extra shuffle), and orders can be pre-aggregated per session *before* the
  session join: each order has one session, so per-session counts and sums
  add up to exactly the reference's distinct counts and sums.
* Every aggregation is partial + final, so a hot key (a channel, a month, a
  product holding a third of the rows) is collapsed map-side before the
  shuffle.
* Unpartitioned ``RANK()`` and exact medians go through
  ``functions.order_stats`` instead of a single task. M1, M2, M4 and M4a run their aggregation when they are called, into
  a stored table (a row per channel, product, or month and price); the frame they return reads that table.
* Small dimension joins (products) are left to AQE, which broadcasts only
  after measuring the materialised side against the broadcast threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import (
    double_pct_key,
    exact_mean,
    month_index,
    month_start,
    pct,
    pct_rounded,
    ratio,
    round_half_up,
    ts_literal,
)
from ledgerline.functions.order_stats import RankSpec, stored_median, stored_ranks

# The reference's report constants.
DEFAULT_SINCE = "2013-01-01"
DEFAULT_MIN_SESSIONS = 100
DEFAULT_PERIOD = ("2012-04-01", "2012-05-01")
SOURCE_DEFAULT = "direct"
CAMPAIGN_DEFAULT = "organic"
SEGMENT_FIRST_TIME = "First-Time Visitor"
SEGMENT_REPEAT_GUEST = "Repeat Guest"
SEGMENT_REPEAT_REGISTERED = "Repeat Registered"


def orders_per_session(orders: DataFrame) -> DataFrame:
    """One row per ``website_session_id`` that has orders: order count,
    revenue sum and count of priced orders (for averages)."""
    return (
        orders.filter(F.col("website_session_id").isNotNull())
        .groupBy("website_session_id")
        .agg(
            F.count("order_id").alias("_orders"),
            F.sum("price_usd").alias("_revenue"),
            F.count("price_usd").alias("_priced"),
        )
    )


# --------------------------------------------------------------------- M1
def channel_performance(
    sessions: DataFrame,
    orders: DataFrame,
    since: str = DEFAULT_SINCE,
    min_sessions: int = DEFAULT_MIN_SESSIONS,
) -> DataFrame:
    out = channel_metrics(sessions, orders, since, min_sessions)
    return stored_ranks(out, [RankSpec(F.col("conversion_rate_pct"), "conversion_rank")])


def channel_metrics(
    sessions: DataFrame,
    orders: DataFrame,
    since: str = DEFAULT_SINCE,
    min_sessions: int = DEFAULT_MIN_SESSIONS,
) -> DataFrame:
    """M1 before ranking: one row per channel above the session threshold."""
    s = sessions.filter(F.col("created_at") >= ts_literal(since)).select(
        "website_session_id",
        F.coalesce(F.col("utm_source"), F.lit(SOURCE_DEFAULT)).alias("utm_source"),
        F.coalesce(F.col("utm_campaign"), F.lit(CAMPAIGN_DEFAULT)).alias("utm_campaign"),
    )
    metrics = (
        s.join(orders_per_session(orders), "website_session_id", "left")
        .groupBy("utm_source", "utm_campaign")
        .agg(
            F.count("website_session_id").alias("sessions"),
            F.coalesce(F.sum("_orders"), F.lit(0)).alias("orders"),
            F.sum("_revenue").alias("_revenue"),
        )
        .filter(F.col("sessions") > min_sessions)
    )
    revenue = round_half_up("_revenue", 0)
    out = metrics.select(
        "utm_source",
        "utm_campaign",
        F.col("sessions").cast("bigint").alias("sessions"),
        F.col("orders").cast("bigint").alias("orders"),
        revenue.alias("revenue"),
        pct_rounded("orders", "sessions").alias("conversion_rate_pct"),
        round_half_up(ratio("_revenue", "orders"), 2).alias("avg_order_value"),
        revenue.alias("total_revenue"),
    )
    return out


# --------------------------------------------------------------------- M2
def product_profitability(
    products: DataFrame, order_items: DataFrame, refunds: DataFrame
) -> DataFrame:
    out = product_metrics(products, order_items, refunds)
    # PostgreSQL sorts NULL first under DESC: products without sales rank 1.
    out = stored_ranks(
        out,
        [
            RankSpec(F.col("_profit_key"), "profit_rank", True, True),
            RankSpec(F.col("_margin_key"), "margin_rank", True, True),
        ],
    )
    return out.drop("_profit_key", "_margin_key")


def product_metrics(
    products: DataFrame, order_items: DataFrame, refunds: DataFrame
) -> DataFrame:
    """M2 before ranking: one row per product with the two rank keys
    (unrounded profit, margin as a ratio of doubles)."""
    # Items are scanned once. Refunds are reduced to a row per item, and an item meets at most one of
    # them, so one partial aggregation per product after the join counts both sides (a hot product
    # is collapsed map-side). Item ids are unique: the join has no hot key.
    refunds_per_item = refunds.groupBy("order_item_id").agg(
        F.count("order_item_refund_id").alias("_n"),
        F.sum("refund_amount_usd").alias("_amt"),
    )
    per_product = (
        order_items.select("order_item_id", "product_id", "price_usd", "cogs_usd")
        .join(refunds_per_item, "order_item_id", "left")
        .groupBy("product_id")
        .agg(
            F.count("order_item_id").alias("_units"),
            F.sum("price_usd").cast("decimal(20,2)").alias("_revenue"),
            F.sum("cogs_usd").cast("decimal(20,4)").alias("_cogs"),
            F.sum("_n").alias("_refund_count"),
            F.sum("_amt").cast("decimal(20,2)").alias("_refund_amount"),
        )
    )
    joined = products.select("product_id", "product_name").join(per_product, "product_id", "left")
    profit = F.col("_revenue") - F.col("_cogs")
    refund_amount = F.coalesce(F.col("_refund_amount"), F.lit(0).cast("decimal(20,2)"))
    out = joined.select(
        "product_name",
        F.coalesce(F.col("_units"), F.lit(0)).cast("bigint").alias("units_sold"),
        round_half_up("_cogs", 0).alias("total_cogs"),
        round_half_up("_revenue", 0).alias("gross_revenue"),
        round_half_up(profit, 0).alias("gross_profit"),
        pct_rounded(profit, "_revenue").alias("profit_margin_pct"),
        F.coalesce(F.col("_refund_count"), F.lit(0)).cast("bigint").alias("refund_count"),
        round_half_up(refund_amount, 0).alias("total_refund_amount"),
        pct_rounded(refund_amount, "_revenue").alias("refund_rate_of_revenue_pct"),
        profit.alias("_profit_key"),
        double_pct_key(profit, "_revenue").alias("_margin_key"),
    )
    return out


# --------------------------------------------------------------------- M3
def monthly_sales_and_refunds(
    order_items: DataFrame,
    refunds: DataFrame,
    products: DataFrame,
    since: str = DEFAULT_SINCE,
) -> DataFrame:
    """Units sold per (item month, product name) left-joined on both keys to
    refunds per (refund month, product name); refunds default to 0.

    Both sides are aggregated to (month, product_id) before the product join,
    so the join and the name re-aggregation only see pre-reduced rows."""
    names = products.select("product_id", "product_name")
    sales = (
        order_items.filter(F.col("created_at") >= ts_literal(since))
        .groupBy(month_start("created_at").alias("month"), "product_id")
        .agg(F.count("order_item_id").alias("_u"))
        .join(names, "product_id")
        .groupBy("month", "product_name")
        .agg(F.sum("_u").alias("units_sold_that_month"))
    )
    # Refunds are keyed per item and rarely repeat, so they are joined to the
    # items' (id, product) columns as they are (one exchange per side, by
    # item) and only then reduced per (month, product); pre-aggregating by
    # (month, item) first would add an exchange and remove almost nothing.
    monthly_refunds = (
        refunds.filter(F.col("created_at") >= ts_literal(since))
        .select("order_item_id", "order_item_refund_id", month_start("created_at").alias("month"))
        .join(order_items.select("order_item_id", "product_id"), "order_item_id")
        .groupBy("month", "product_id")
        .agg(F.count("order_item_refund_id").alias("_r"))
        .join(names, "product_id")
        .groupBy("month", "product_name")
        .agg(F.sum("_r").alias("refunds"))
    )
    return sales.join(monthly_refunds, ["month", "product_name"], "left").withColumn(
        "refunds", F.coalesce(F.col("refunds"), F.lit(0))
    )


def refund_rate_trends(
    order_items: DataFrame,
    refunds: DataFrame,
    products: DataFrame,
    since: str = DEFAULT_SINCE,
    window_rows: int = 3,
) -> DataFrame:
    combined = monthly_sales_and_refunds(order_items, refunds, products, since)
    rate = pct("refunds", "units_sold_that_month")
    w = (
        Window.partitionBy("product_name")
        .orderBy("month")
        .rowsBetween(-(window_rows - 1), Window.currentRow)
    )
    return combined.select(
        F.col("month").alias("refund_month"),
        "product_name",
        F.col("refunds").cast("bigint").alias("refunds"),
        F.col("units_sold_that_month").cast("bigint").alias("units_sold_that_month"),
        round_half_up(rate, 2).alias("refund_rate_pct"),
        round_half_up(F.avg(rate).over(w), 2).alias("rolling_3m_avg_refund_rate_pct"),
    )


# --------------------------------------------------------------------- M4
def _order_month_metrics(orders: DataFrame) -> DataFrame:
    month = month_start("created_at").alias("month")
    metrics = orders.groupBy(month).agg(
        F.count("order_id").alias("orders"),
        F.sum("items_purchased").alias("_items"),
        F.count("items_purchased").alias("_items_n"),
        F.sum("price_usd").cast("decimal(20,2)").alias("_revenue"),
        F.count("price_usd").alias("_priced"),
        F.count(F.when(F.col("items_purchased") == 1, F.col("order_id"))).alias(
            "single_item_orders"
        ),
        F.count(F.when(F.col("items_purchased") > 1, F.col("order_id"))).alias(
            "multi_item_orders"
        ),
    )
    median = stored_median(
        orders.select(month_start("created_at").alias("month"), "price_usd"),
        ["month"],
        "price_usd",
        "_median",
    )
    m = metrics.alias("m").join(
        median.alias("d"), F.col("m.month").eqNullSafe(F.col("d.month")), "left"
    )
    return m.select(
        F.col("m.month").alias("month"),
        F.col("orders").cast("bigint").alias("orders"),
        round_half_up(exact_mean("_items", "_items_n"), 2).alias("avg_items_per_order"),
        round_half_up(exact_mean("_revenue", "_priced"), 2).alias("aov"),
        round_half_up("_median", 2).alias("median_order_value"),
        F.round(F.col("_revenue"), 0).alias("_revenue_rounded"),
        F.col("single_item_orders").cast("bigint").alias("single_item_orders"),
        F.col("multi_item_orders").cast("bigint").alias("multi_item_orders"),
        pct_rounded("multi_item_orders", "orders").alias("pct_multi_item"),
    )


def order_value_trends(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    om = _order_month_metrics(orders)
    sm = sessions.groupBy(month_start("created_at").alias("month")).agg(
        F.count("website_session_id").alias("sessions")
    )
    j = om.join(sm, "month", "left")
    return j.select(
        "month",
        F.col("sessions").cast("bigint").alias("sessions"),
        "orders",
        "avg_items_per_order",
        "aov",
        "median_order_value",
        F.col("_revenue_rounded").cast("double").alias("monthly_revenue"),
        "single_item_orders",
        "multi_item_orders",
        "pct_multi_item",
        round_half_up(ratio("_revenue_rounded", "sessions"), 2).alias("revenue_per_session"),
    )


def order_value_trends_orders_only(orders: DataFrame) -> DataFrame:
    om = _order_month_metrics(orders)
    return om.select(
        "month",
        "orders",
        "avg_items_per_order",
        "aov",
        "median_order_value",
        F.col("_revenue_rounded").cast("double").alias("monthly_revenue"),
        "single_item_orders",
        "multi_item_orders",
        "pct_multi_item",
    )


def revenue_per_session(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue credited to the session's month, unrounded before dividing."""
    s = sessions.select("website_session_id", month_start("created_at").alias("month"))
    g = (
        s.join(orders_per_session(orders), "website_session_id", "left")
        .groupBy("month")
        .agg(
            F.count("website_session_id").alias("sessions"),
            F.coalesce(F.sum("_orders"), F.lit(0)).alias("orders"),
            F.sum("_revenue").alias("_revenue"),
        )
    )
    return g.select(
        "month",
        F.col("sessions").cast("bigint").alias("sessions"),
        F.col("orders").cast("bigint").alias("orders"),
        round_half_up(ratio("_revenue", "sessions"), 2).alias("revenue_per_session"),
    )


# --------------------------------------------------------------------- M5
def first_purchase_join(orders: DataFrame) -> DataFrame:
    """Each order with its user's first order time: ``min`` per user (a
    partial aggregate, safe for a user with a huge share of orders) joined
    back on the user; AQE splits a hot user's join partition at run time."""
    first = (
        orders.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min("created_at").alias("first_order_at"))
    )
    return orders.join(first, "user_id")


def _user_months(orders: DataFrame) -> DataFrame:
    """Distinct (user, order month) with the user's cohort and month number.

    Deduplicating first bounds every user to (number of months) rows, so the
    per-user window that finds the cohort never sees a hot user's raw orders.
    (A per-user ``collect_set`` of months saves one exchange but runs on the
    object hash aggregate, which turns sort-based after a few hundred keys per
    task; measured slower here, and worse with a billion users.)
    """
    um = (
        orders.filter(F.col("user_id").isNotNull())
        .select("user_id", month_start("created_at").alias("order_month"))
        .distinct()
    )
    by_user = Window.partitionBy("user_id")
    first = Window.partitionBy("user_id").orderBy(F.col("order_month").asc_nulls_first())
    return um.select(
        "user_id",
        "order_month",
        F.min("order_month").over(by_user).alias("cohort_month"),
        (F.row_number().over(first) == 1).alias("_first_row"),
    ).withColumn("month_number", month_index("order_month", "cohort_month"))


def cohort_retention(
    orders: DataFrame,
    months: Sequence[int] = tuple(range(7)),
    pct_months: Sequence[int] = (1, 6),
) -> DataFrame:
    um = _user_months(orders)
    aggs = [F.count(F.when(F.col("_first_row"), 1)).alias("customers_in_cohort")]
    aggs += [
        F.count(F.when(F.col("month_number") == k, 1)).alias(f"month_{k}") for k in months
    ]
    g = um.groupBy("cohort_month").agg(*aggs)
    cols = [F.col("cohort_month"), F.col("customers_in_cohort").cast("bigint")]
    cols += [F.col(f"month_{k}").cast("bigint") for k in months]
    cols += [
        pct_rounded(f"month_{k}", "customers_in_cohort").alias(f"retention_m{k}_pct")
        for k in pct_months
    ]
    return g.select(*cols)


def cohort_retention_long(
    orders: DataFrame, months: Sequence[int] = tuple(range(7))
) -> DataFrame:
    """The retention grid unpivoted: one row per (cohort, month number)."""
    wide = cohort_retention(orders, months, pct_months=())
    long = wide.unpivot(
        ["cohort_month", "customers_in_cohort"],
        [f"month_{k}" for k in months],
        "_m",
        "active_customers",
    )
    return long.select(
        "cohort_month",
        F.regexp_extract("_m", r"(\d+)$", 1).cast("int").alias("month_number"),
        "customers_in_cohort",
        F.col("active_customers").cast("bigint").alias("active_customers"),
        pct_rounded("active_customers", "customers_in_cohort").alias("retention_pct"),
    )


# --------------------------------------------------------------------- M6
def customer_segment(is_repeat: str = "is_repeat_session", user: str = "user_id"):
    """Segment of a raw session row; reads the raw 0/1 flag (NULL falls through
    to the last branch)."""
    return (
        F.when(F.col(is_repeat) == 0, SEGMENT_FIRST_TIME)
        .when((F.col(is_repeat) == 1) & F.col(user).isNull(), SEGMENT_REPEAT_GUEST)
        .otherwise(SEGMENT_REPEAT_REGISTERED)
    )


def visitor_segments(
    sessions: DataFrame, orders: DataFrame, since: str = DEFAULT_SINCE
) -> DataFrame:
    s = sessions.filter(F.col("created_at") >= ts_literal(since)).select(
        "website_session_id", customer_segment().alias("customer_type"), "device_type"
    )
    g = (
        s.join(orders_per_session(orders), "website_session_id", "left")
        .groupBy("customer_type")
        .agg(
            F.count("website_session_id").alias("sessions"),
            F.coalesce(F.sum("_orders"), F.lit(0)).alias("orders"),
            F.sum("_revenue").alias("_revenue"),
            F.sum("_priced").alias("_priced"),
            F.count(F.when(F.col("device_type") == "mobile", 1)).alias("_mobile"),
        )
    )
    return g.select(
        "customer_type",
        F.col("sessions").cast("bigint").alias("sessions"),
        F.col("orders").cast("bigint").alias("orders"),
        pct_rounded("orders", "sessions").alias("conversion_rate_pct"),
        round_half_up(exact_mean("_revenue", "_priced"), 2).alias("avg_order_value"),
        round_half_up("_revenue", 0).alias("total_revenue"),
        pct_rounded("_mobile", "sessions").alias("pct_mobile"),
    )


# --------------------------------------------------------------------- M7
def conversion_for_period(
    sessions: DataFrame,
    orders: DataFrame,
    start: str = DEFAULT_PERIOD[0],
    end: str = DEFAULT_PERIOD[1],
) -> DataFrame:
    """Sessions, orders and conversion % for sessions in ``[start, end)``."""
    s = sessions.filter(
        (F.col("created_at") >= ts_literal(start)) & (F.col("created_at") < ts_literal(end))
    ).select("website_session_id")
    # orders of other periods go before anything is grouped
    wanted = orders.join(s, "website_session_id", "left_semi")
    g = s.join(orders_per_session(wanted), "website_session_id", "left").agg(
        F.count("website_session_id").alias("sessions"),
        F.coalesce(F.sum("_orders"), F.lit(0)).alias("orders"),
    )
    return g.select(
        F.col("sessions").cast("bigint").alias("sessions"),
        F.col("orders").cast("bigint").alias("orders"),
        pct_rounded("orders", "sessions").alias("conversion_rate"),
    )
