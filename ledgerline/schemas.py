"""Declared schemas of the six raw tables and their load rules.

A ``TableSpec`` carries what the loader needs per table: the declared
``StructType`` (business columns only; the two audit columns are added by the
cleaner), the primary key, the load strategy and which columns are cast or
stripped during cleaning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

AUDIT_LOADED_AT = "_etl_loaded_at"
AUDIT_SOURCE = "_etl_source"

# Fixed values that must equal the reference's rules: column lists used by
# the cleaner, and the load strategy per table.
TIMESTAMP_COLUMNS = ("created_at",)
NUMERIC_COLUMNS = ("price_usd", "cogs_usd", "refund_amount_usd")
TEXT_COLUMNS = (
    "utm_source",
    "utm_campaign",
    "utm_content",
    "device_type",
    "pageview_url",
    "product_name",
    "http_referer",
)
INCREMENTAL = "incremental"
FULL_REFRESH = "full_refresh"

MONEY = T.DecimalType(10, 2)


@dataclass(frozen=True)
class TableSpec:
    name: str
    pk: str
    strategy: str
    schema: T.StructType
    watermark_column: str = "created_at"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def full_schema(self) -> T.StructType:
        """Business columns plus the audit columns, as stored in a target."""
        return T.StructType(
            list(self.schema.fields)
            + [
                T.StructField(AUDIT_LOADED_AT, T.TimestampNTZType(), True),
                T.StructField(AUDIT_SOURCE, T.StringType(), True),
            ]
        )


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


_TS = T.TimestampNTZType()

TABLES: dict[str, TableSpec] = {
    "orders": TableSpec(
        "orders",
        "order_id",
        INCREMENTAL,
        T.StructType(
            [
                _f("order_id", T.LongType()),
                _f("created_at", _TS),
                _f("website_session_id", T.LongType()),
                _f("user_id", T.LongType()),
                _f("primary_product_id", T.IntegerType()),
                _f("items_purchased", T.IntegerType()),
                _f("price_usd", MONEY),
                _f("cogs_usd", MONEY),
            ]
        ),
    ),
    "order_items": TableSpec(
        "order_items",
        "order_item_id",
        INCREMENTAL,
        T.StructType(
            [
                _f("order_item_id", T.LongType()),
                _f("created_at", _TS),
                _f("order_id", T.LongType()),
                _f("product_id", T.IntegerType()),
                _f("is_primary_item", T.ShortType()),
                _f("price_usd", MONEY),
                _f("cogs_usd", MONEY),
            ]
        ),
    ),
    "order_item_refunds": TableSpec(
        "order_item_refunds",
        "order_item_refund_id",
        INCREMENTAL,
        T.StructType(
            [
                _f("order_item_refund_id", T.LongType()),
                _f("created_at", _TS),
                _f("order_item_id", T.LongType()),
                _f("order_id", T.LongType()),
                _f("refund_amount_usd", MONEY),
            ]
        ),
    ),
    "products": TableSpec(
        "products",
        "product_id",
        FULL_REFRESH,
        T.StructType(
            [
                _f("product_id", T.IntegerType()),
                _f("created_at", _TS),
                _f("product_name", T.StringType()),
            ]
        ),
    ),
    "website_sessions": TableSpec(
        "website_sessions",
        "website_session_id",
        INCREMENTAL,
        T.StructType(
            [
                _f("website_session_id", T.LongType()),
                _f("created_at", _TS),
                _f("user_id", T.LongType()),
                _f("is_repeat_session", T.ShortType()),
                _f("utm_source", T.StringType()),
                _f("utm_campaign", T.StringType()),
                _f("utm_content", T.StringType()),
                _f("device_type", T.StringType()),
                _f("http_referer", T.StringType()),
            ]
        ),
    ),
    "website_pageviews": TableSpec(
        "website_pageviews",
        "website_pageview_id",
        INCREMENTAL,
        T.StructType(
            [
                _f("website_pageview_id", T.LongType()),
                _f("created_at", _TS),
                _f("website_session_id", T.LongType()),
                _f("pageview_url", T.StringType()),
            ]
        ),
    ),
}

# The extract order of the pipeline: one file per table, named <table>.csv.
TABLE_ORDER = (
    "orders",
    "order_items",
    "products",
    "website_sessions",
    "website_pageviews",
    "order_item_refunds",
)


def spec_for(table: str) -> TableSpec | None:
    return TABLES.get(table)


def strategy_for(table: str) -> str:
    """Unknown tables load incrementally, as in the reference."""
    spec = TABLES.get(table)
    return spec.strategy if spec else INCREMENTAL
