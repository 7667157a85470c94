"""Data-quality and post-load verification operators (VF1-VF4, unique and
not-null tests), as DataFrames instead of console prints.

``table_profile`` computes row count, NULL-key count and the created_at range
of a table in one aggregation pass; the three verification reports are
projections of it, so checking six tables costs six scans, not eighteen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import TABLE_ORDER, spec_for

# The tables the date-range check covers.
DATE_RANGE_TABLES = ("orders", "website_sessions", "website_pageviews")

PROFILE_COLUMNS = ["table_name", "pk_column", "row_count", "null_pk_count", "min_date", "max_date"]


def table_profile(df: DataFrame, table: str, date_col: str = "created_at") -> DataFrame:
    """One row: table, rows, NULL keys, min/max ``created_at`` as dates."""
    spec = spec_for(table)
    pk = spec.pk if spec else None
    has_date = date_col in df.columns
    return df.agg(
        F.lit(table).alias("table_name"),
        F.lit(pk).cast("string").alias("pk_column"),
        F.count(F.lit(1)).alias("row_count"),
        (F.count_if(F.col(pk).isNull()) if pk else F.lit(0).cast("bigint")).alias("null_pk_count"),
        (F.to_date(F.min(date_col)) if has_date else F.lit(None).cast("date")).alias("min_date"),
        (F.to_date(F.max(date_col)) if has_date else F.lit(None).cast("date")).alias("max_date"),
    )


def profiles(tables: dict[str, DataFrame], order: Iterable[str] = TABLE_ORDER) -> DataFrame:
    parts = [table_profile(tables[t], t) for t in order if t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """VF1."""
    return profiles(tables).select("table_name", "row_count")


def null_pk_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """VF2."""
    return profiles(tables).select("table_name", "pk_column", "null_pk_count")


def date_ranges(tables: dict[str, DataFrame], which=DATE_RANGE_TABLES) -> DataFrame:
    """VF3."""
    return profiles({t: tables[t] for t in which if t in tables}, which).select(
        "table_name", "min_date", "max_date"
    )


def sample_rows(orders: DataFrame, n: int = 5) -> DataFrame:
    """VF4: a deterministic sample (first ``n`` orders by key). ``orderBy +
    limit`` is planned as a distributed top-k, not a sort of the table."""
    return (
        orders.select(
            "order_id",
            F.to_date("created_at").alias("order_date"),
            "price_usd",
            "items_purchased",
        )
        .orderBy("order_id")
        .limit(n)
    )


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Unique test: non-NULL values of ``column`` that occur more than once,
    with their count (empty when the test passes)."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Not-null test: the rows whose ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def schema_tests(models: dict[str, DataFrame]) -> DataFrame:
    """The unique + not_null tests on every staging model's key: one row per
    (model, column, test) with the failure count, one pass per model."""
    parts = []
    for table in TABLE_ORDER:
        name = f"stg_{table}"
        if name not in models:
            continue
        pk = spec_for(table).pk
        per_key = models[name].groupBy(pk).agg(F.count(F.lit(1)).alias("_n"))
        counts = per_key.agg(
            F.coalesce(F.sum(F.when(F.col(pk).isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
            F.count_if(F.col(pk).isNotNull() & (F.col("_n") > 1)).alias("dupes"),
        )
        for test, col in (("unique", "dupes"), ("not_null", "nulls")):
            parts.append(
                counts.select(
                    F.lit(name).alias("model"),
                    F.lit(pk).alias("column_name"),
                    F.lit(test).alias("test"),
                    F.col(col).cast("bigint").alias("failures"),
                    F.when(F.col(col) == 0, "pass").otherwise("fail").alias("status"),
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
