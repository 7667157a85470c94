"""Staging transforms: one per raw table, projection only (plus 0/1 flags to
booleans). Applied lazily, they cost nothing: Catalyst collapses them into
whatever report reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_to_bool(c: str) -> Column:
    """``CASE WHEN flag = 1 THEN true ELSE false END`` (NULL -> false)."""
    return F.coalesce(F.col(c) == 1, F.lit(False)).alias(c)


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "created_at",
        "website_session_id",
        "user_id",
        "primary_product_id",
        "items_purchased",
        "price_usd",
        "cogs_usd",
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_item_id",
        "created_at",
        "order_id",
        "product_id",
        flag_to_bool("is_primary_item"),
        "price_usd",
        "cogs_usd",
    )


def stg_order_item_refunds(refunds: DataFrame) -> DataFrame:
    return refunds.select(
        "order_item_refund_id", "created_at", "order_item_id", "order_id", "refund_amount_usd"
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "created_at", "product_name")


def stg_website_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "website_session_id",
        "created_at",
        "user_id",
        flag_to_bool("is_repeat_session"),
        "utm_source",
        "utm_campaign",
        "utm_content",
        "device_type",
        "http_referer",
    )


def stg_website_pageviews(pageviews: DataFrame) -> DataFrame:
    return pageviews.select("website_pageview_id", "created_at", "website_session_id", "pageview_url")


STAGING = {
    "orders": stg_orders,
    "order_items": stg_order_items,
    "order_item_refunds": stg_order_item_refunds,
    "products": stg_products,
    "website_sessions": stg_website_sessions,
    "website_pageviews": stg_website_pageviews,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging for every raw table present; keyed ``stg_<table>``."""
    return {f"stg_{t}": fn(raw[t]) for t, fn in STAGING.items() if t in raw}


def register_views(frames: dict[str, DataFrame]) -> None:
    """Materialise frames as temp views (the 'view' materialisation)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
