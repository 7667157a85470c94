"""The six raw e-commerce tables, derived by Spark from the TPC-H-style parquet
test tables (``orders``, ``lineitem``, ``part``, ``events``).

The derivation is part of the plan of every registered query, so each query's
work grows with the given tables. Column names and types follow the declared
schemas (``ledgerline.schemas``); prices use ``decimal(12,2)`` for head-room and
item ``cogs_usd`` keeps scale 4 so nothing is rounded before aggregation.

Everything keyed by order is computed on one hash partitioning of
``l_orderkey`` / ``o_orderkey``: the item numbering window, the per-order line
aggregate and the join back to orders share the same exchange.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import stored
from ledgerline.sources.files import PARQUET_OPTIONS

# Fixed values of the derivation (channel and device mapping).
PRIORITY_TO_SOURCE = {"1-URGENT": "gsearch", "2-HIGH": "bsearch", "3-MEDIUM": "socialbook"}
STATUS_TO_CAMPAIGN = {"F": "brand", "O": "nonbrand"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: lines an order may have; item keys are order key * LINES_PER_ORDER + line number
LINES_PER_ORDER = 1_000_000


def item_key(order: str, line: str) -> Column:
    """Key of an order line; fails on a line number that would run into the next order's keys."""
    n = F.col(line)
    too_many = F.raise_error(F.lit(f"an order has {LINES_PER_ORDER} lines or more")).cast("bigint")
    return F.when(n < LINES_PER_ORDER, F.col(order) * LINES_PER_ORDER + n).otherwise(too_many)


def _mapped(column: str, mapping: dict[str, str]):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(column) == k, v) if expr is None else expr.when(F.col(column) == k, v))
    return expr


@dataclass
class ShopTables:
    """Lazily built raw tables over one test-data folder."""

    spark: SparkSession
    sf_dir: str

    def _read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def _read_by(self, name: str, key: str) -> DataFrame:
        """Scan hash-partitioned on the key every consumer clusters by anyway
        (line items: the numbering window by order key). The exchange the
        window would add is moved up to the scan, so the per-row work after
        it runs on all partitions even when a test file is a single row
        group, and no extra shuffle appears."""
        return self._read(name).repartition(key)

    @cached_property
    def _numbered_lines(self) -> DataFrame:
        li = self._read_by("lineitem", "l_orderkey").select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_returnflag",
            "l_shipdate",
        )
        w = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
        )
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return li.withColumn("_n", F.row_number().over(w)).select(
            "l_orderkey",
            "l_partkey",
            "l_returnflag",
            "l_shipdate",
            "_n",
            price.alias("_price"),
            (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).alias("_cogs"),
        )

    @cached_property
    def _order_dates(self) -> DataFrame:
        return self._read("orders").select("o_orderkey", "o_orderdate")

    def store_lines(self) -> None:
        """Number the lines once for all tables that are built of them: they are written with the dates of their order (none,
        or several, if its key is missing or repeats) and read from there."""
        dates = self._order_dates.groupBy("o_orderkey").agg(F.collect_list(F.struct("o_orderdate")).alias("_dates"))
        lines = self._numbered_lines
        kept = lines.join(dates, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(*lines.columns, "_dates")
        saved = stored(kept, "numbered-lines", **PARQUET_OPTIONS)
        self.__dict__["_numbered_lines"] = saved.drop("_dates")
        self.__dict__["_items_with_dates"] = saved.select("*", F.explode("_dates").alias("_date")).select(
            *lines.columns, F.col("l_orderkey").alias("o_orderkey"), F.col("_date.o_orderdate").alias("o_orderdate")
        )

    @cached_property
    def _items_with_dates(self) -> DataFrame:
        return self._numbered_lines.join(
            self._order_dates, F.col("l_orderkey") == F.col("o_orderkey")
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._items_with_dates.select(
            item_key("l_orderkey", "_n").alias("order_item_id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").cast("int").alias("product_id"),
            F.when(F.col("_n") == 1, 1).otherwise(0).cast("smallint").alias("is_primary_item"),
            F.col("_price").alias("price_usd"),
            F.col("_cogs").alias("cogs_usd"),
        )

    @cached_property
    def order_item_refunds(self) -> DataFrame:
        item_id = item_key("l_orderkey", "_n")
        return self._items_with_dates.filter(F.col("l_returnflag") == "R").select(
            item_id.alias("order_item_refund_id"),
            F.greatest("o_orderdate", "l_shipdate").alias("created_at"),
            item_id.alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("_price").alias("refund_amount_usd"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        lines = self._numbered_lines.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("_lines"),
            F.max(F.when(F.col("_n") == 1, F.col("l_partkey"))).alias("_primary"),
            F.sum("_cogs").alias("_cogs"),
        )
        o = self._read("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        return o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("created_at"),
            (F.col("o_orderkey") * 10).alias("website_session_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("_primary").cast("int").alias("primary_product_id"),
            F.coalesce(F.col("_lines"), F.lit(0)).cast("int").alias("items_purchased"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("price_usd"),
            F.col("_cogs").alias("cogs_usd"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._read("part").select(
            F.col("p_partkey").cast("int").alias("product_id"),
            F.lit(None).cast("timestamp_ntz").alias("created_at"),
            F.col("p_brand").alias("product_name"),
        )

    @cached_property
    def website_sessions(self) -> DataFrame:
        o = self._read("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
        )
        j = F.col("_j")
        exploded = o.withColumn(
            "_j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("o_orderkey") % 4))
        )
        return exploded.select(
            (F.col("o_orderkey") * 10 + j).alias("website_session_id"),
            (F.col("o_orderdate") - F.make_dt_interval(days=j.cast("int")))
            .cast("timestamp_ntz")
            .alias("created_at"),
            F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("bigint"))
            .otherwise(F.col("o_custkey"))
            .alias("user_id"),
            F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(1).cast("smallint").alias(
                "is_repeat_session"
            ),
            _mapped("o_orderpriority", PRIORITY_TO_SOURCE).alias("utm_source"),
            _mapped("o_orderstatus", STATUS_TO_CAMPAIGN).alias("utm_campaign"),
            F.lit(None).cast("string").alias("utm_content"),
            F.when((F.col("o_orderkey") + j) % 3 == 0, "mobile").otherwise("desktop").alias(
                "device_type"
            ),
            F.lit(None).cast("string").alias("http_referer"),
        )

    @cached_property
    def website_pageviews(self) -> DataFrame:
        return self._read("events").select(
            F.col("event_id").alias("website_pageview_id"),
            F.col("ts").alias("created_at"),
            (F.col("user_id") * 10).alias("website_session_id"),
            F.concat(F.lit("/"), F.col("event_type")).alias("pageview_url"),
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def all(self) -> dict[str, DataFrame]:
        return {
            n: self.table(n)
            for n in (
                "orders",
                "order_items",
                "order_item_refunds",
                "products",
                "website_sessions",
                "website_pageviews",
            )
        }


def shop_tables(spark: SparkSession, sf_dir: str) -> ShopTables:
    return ShopTables(spark, sf_dir)
