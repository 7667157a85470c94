"""Registered queries for cleaning, validation, loading, verification and the
relational / scalar primitives, each next to its DuckDB oracle.

Every query starts from the given test tables (through the derived raw
tables, and for cleaning/loading through their deterministic corruption in
``sources.dirty``). Queries that load data write below the session's shared
checkpoint folder and read the written target back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.numeric import (
    month_index,
    month_start,
    pct_rounded,
    round_half_up,
    ts_literal,
)
from ledgerline.functions.order_stats import RankSpec, stored_median, stored_ranks
from ledgerline.operators import clean, load, quality, reports, staging, validate
from ledgerline.plans import marts, oracle_sql as O
from ledgerline.plans.oracle_sql import R, ts, with_shop
from ledgerline.plans.pipeline import read_loaded, run_pipeline
from ledgerline.schemas import (
    NUMERIC_COLUMNS,
    TABLE_ORDER,
    TEXT_COLUMNS,
    spec_for,
)
from ledgerline.session import scratch_path
from ledgerline.sources import csv as csv_source
from ledgerline.sources.dirty import dirty_raw, dirty_sql, strip_sql
from ledgerline.sources.testdata import ShopTables, item_key, read_table

# Fixed parameters of the load checks.
RUN_TS_1 = "2024-01-01 00:00:00"
RUN_TS_2 = "2024-01-02 00:00:00"
CUT = O.WATERMARK_CUT  # target holds orders before this time
OVERLAP_FROM = "1997-10-01"  # the second batch re-reads from here

Spec = tuple[Callable[[ShopTables], DataFrame], str | None]
CHECKS: dict[str, Spec] = {}


def check(key: str, sql: str | None):
    def deco(fn: Callable[[ShopTables], DataFrame]):
        CHECKS[key] = (fn, sql)
        return fn

    return deco


# ------------------------------------------------------------ SQL helpers
_DUCK = {
    T.LongType(): "BIGINT",
    T.IntegerType(): "INTEGER",
    T.ShortType(): "SMALLINT",
    T.StringType(): "VARCHAR",
    T.TimestampNTZType(): "TIMESTAMP",
}


def _final(expr: str, dtype: T.DataType) -> str:
    """SQL twin of ``registry.finalize`` for one declared column (money is
    first brought to its declared decimal, as the loader does)."""
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return f"CAST({expr} AS BIGINT)"
    if isinstance(dtype, T.DecimalType):
        return f"CAST(CAST({expr} AS DECIMAL({dtype.precision},{dtype.scale})) AS DOUBLE)"
    return expr


def _typed_expr(table: str, name: str) -> str:
    f = spec_for(table).schema[name]
    if name == "created_at":
        return "TRY_CAST(created_at AS TIMESTAMP)"
    if name in NUMERIC_COLUMNS:
        return f"TRY_CAST({name} AS DECIMAL(10,2))"
    if name in TEXT_COLUMNS:
        return strip_sql(name)
    return f"TRY_CAST({name} AS {_DUCK[f.dataType]})"


def dirty_cte(table: str) -> str:
    return f"dirty_{table} AS (\n{dirty_sql(table)})"


def dedup_cte(table: str) -> str:
    cols = ", ".join(spec_for(table).columns)
    return (
        f"dedup_{table} AS (SELECT {cols}, min(_dirt_seq) AS _seq "
        f"FROM dirty_{table} GROUP BY ALL)"
    )


def typed_cte(table: str) -> str:
    """Cleaned rows (C2-C6): typed, NULL keys dropped, ``_seq`` kept."""
    spec = spec_for(table)
    exprs = ", ".join(f"{_typed_expr(table, c)} AS {c}" for c in spec.columns)
    return (
        f"typed_{table} AS (SELECT * FROM (SELECT {exprs}, _seq FROM dedup_{table}) "
        f"WHERE {spec.pk} IS NOT NULL)"
    )


def clean_ctes(table: str) -> list[str]:
    return [dirty_cte(table), dedup_cte(table), typed_cte(table)]


def final_columns_sql(table: str, prefix: str = "") -> str:
    spec = spec_for(table)
    return ", ".join(
        f"{_final(prefix + f.name, f.dataType)} AS {f.name}" for f in spec.schema.fields
    )


def _dirty(t: ShopTables, table: str) -> DataFrame:
    return dirty_raw(t.table(table), table)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ============================================================ cleaning C1-C8
_S = "website_sessions"
_S_COLS = ", ".join(spec_for(_S).columns)


@check("clean_columns", with_shop(f"SELECT {_S_COLS} FROM dirty_{_S}", dirty_cte(_S)))
def q_clean_columns(t: ShopTables) -> DataFrame:
    return clean.normalize_columns(_dirty(t, _S))


@check("clean_dedup_rows", with_shop(f"SELECT DISTINCT {_S_COLS} FROM dirty_{_S}", dirty_cte(_S)))
def q_clean_dedup_rows(t: ShopTables) -> DataFrame:
    return clean.drop_duplicate_rows(clean.normalize_columns(_dirty(t, _S)))


@check(
    "clean_cast_timestamp",
    with_shop(
        f"SELECT website_session_id, TRY_CAST(created_at AS TIMESTAMP) AS created_at "
        f"FROM (SELECT DISTINCT {_S_COLS} FROM dirty_{_S})",
        dirty_cte(_S),
    ),
)
def q_clean_cast_timestamp(t: ShopTables) -> DataFrame:
    df = clean.drop_duplicate_rows(clean.normalize_columns(_dirty(t, _S)))
    return clean.cast_timestamps(df).select("website_session_id", "created_at")


_I = "order_items"
_I_COLS = ", ".join(spec_for(_I).columns)


@check(
    "clean_cast_numeric",
    with_shop(
        "SELECT order_item_id, CAST(TRY_CAST(price_usd AS DECIMAL(10,2)) AS DOUBLE) AS price_usd, "
        "CAST(TRY_CAST(cogs_usd AS DECIMAL(10,2)) AS DOUBLE) AS cogs_usd "
        f"FROM (SELECT DISTINCT {_I_COLS} FROM dirty_{_I})",
        dirty_cte(_I),
    ),
)
def q_clean_cast_numeric(t: ShopTables) -> DataFrame:
    df = clean.drop_duplicate_rows(clean.normalize_columns(_dirty(t, _I)))
    return clean.cast_numeric(df).select("order_item_id", "price_usd", "cogs_usd")


_S_TEXT = [c for c in spec_for(_S).columns if c in TEXT_COLUMNS]


@check(
    "clean_strip_text",
    with_shop(
        "SELECT website_session_id, "
        + ", ".join(f"{strip_sql(c)} AS {c}" for c in _S_TEXT)
        + f" FROM (SELECT DISTINCT {_S_COLS} FROM dirty_{_S})",
        dirty_cte(_S),
    ),
)
def q_clean_strip_text(t: ShopTables) -> DataFrame:
    df = clean.drop_duplicate_rows(clean.normalize_columns(_dirty(t, _S)))
    return clean.strip_text_columns(df).select("website_session_id", *_S_TEXT)


@check(
    "clean_drop_null_pk",
    with_shop(f"SELECT {final_columns_sql(_S)} FROM typed_{_S}", *clean_ctes(_S)),
)
def q_clean_drop_null_pk(t: ShopTables) -> DataFrame:
    df = clean.normalize_columns(_dirty(t, _S))
    df = clean.drop_duplicate_rows(df)
    df = clean.strip_text_columns(clean.cast_numeric(clean.cast_timestamps(df)))
    df = clean.cast_declared(df, spec_for(_S))
    return clean.drop_null_pk(df, spec_for(_S).pk)


@check(
    "clean_audit_columns",
    with_shop(
        f"SELECT {final_columns_sql(_I)}, {ts(RUN_TS_1)} AS _etl_loaded_at, "
        f"'{_I}' AS _etl_source FROM typed_{_I}",
        *clean_ctes(_I),
    ),
)
def q_clean_audit_columns(t: ShopTables) -> DataFrame:
    return clean.clean_dataframe(_dirty(t, _I), _I, RUN_TS_1)


def _clean_report_sql(table: str) -> str:
    spec = spec_for(table)
    cols = ", ".join(spec.columns)
    pk_t = f"TRY_CAST({spec.pk} AS {_DUCK[spec.schema[spec.pk].dataType]})"
    return (
        f"SELECT '{table}' AS table_name, CAST(sum(_copies) AS BIGINT) AS rows_in, "
        f"CAST(sum(_copies) - count(*) AS BIGINT) AS duplicates_removed, "
        f"count(*) FILTER (WHERE TRY_CAST(created_at AS TIMESTAMP) IS NULL) AS unparseable_dates, "
        f"count(*) FILTER (WHERE {pk_t} IS NULL) AS null_pk_dropped, "
        f"count(*) FILTER (WHERE {pk_t} IS NOT NULL) AS rows_out "
        f"FROM (SELECT {cols}, count(*) AS _copies FROM dirty_{table} GROUP BY ALL)"
    )


@check(
    "clean_report",
    with_shop(
        "\nUNION ALL\n".join(_clean_report_sql(tb) for tb in TABLE_ORDER),
        *[dirty_cte(tb) for tb in TABLE_ORDER],
    ),
)
def q_clean_report(t: ShopTables) -> DataFrame:
    return _union([clean.clean_report(_dirty(t, tb), tb) for tb in TABLE_ORDER])


# ============================================================ validation V1-V5
def _validate_sql(table: str) -> str:
    pk = spec_for(table).pk
    return (
        f"SELECT '{table}' AS table_name, '{pk}' AS pk_column, true AS pk_present, "
        f"count(*) AS row_count, count(*) FILTER (WHERE {pk} IS NULL) AS null_pk_count, "
        f"count({pk}) - count(DISTINCT {pk}) AS duplicate_pk_count, "
        f"count(*) > 0 AND count(*) FILTER (WHERE {pk} IS NULL) = 0 AS passed FROM typed_{table}"
    )


@check(
    "validate_report",
    with_shop(
        "\nUNION ALL\n".join(_validate_sql(tb) for tb in TABLE_ORDER),
        *[c for tb in TABLE_ORDER for c in clean_ctes(tb)],
    ),
)
def q_validate_report(t: ShopTables) -> DataFrame:
    return _union(
        [
            clean.raw_validation_report(_dirty(t, tb), tb)
            for tb in TABLE_ORDER
        ]
    )


_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
_LINE_COLS = ["order_line_id", "l_orderkey", "l_linenumber", *_LINE_ORDER]


def _order_lines(t: ShopTables) -> DataFrame:
    """Lines keyed by (order, line number): a natural key with real repeats."""
    li = read_table(t.spark, t.sf_dir, "lineitem")
    return li.select(
        item_key("l_orderkey", "l_linenumber").alias("order_line_id"),
        "l_orderkey",
        "l_linenumber",
        *_LINE_ORDER,
    )


_ORDER_LINES_SQL = (
    "order_lines AS (SELECT l_orderkey * 1000000 + l_linenumber AS order_line_id, "
    + ", ".join(["l_orderkey", "l_linenumber", *_LINE_ORDER])
    + " FROM lineitem)"
)


@check(
    "dedup_keep_first",
    with_shop(
        f"SELECT {', '.join(c if c != 'l_linenumber' else 'CAST(l_linenumber AS BIGINT) AS l_linenumber' for c in _LINE_COLS)} "
        "FROM order_lines QUALIFY row_number() OVER (PARTITION BY order_line_id ORDER BY "
        + ", ".join(_LINE_ORDER)
        + ") = 1",
        _ORDER_LINES_SQL,
    ),
)
def q_dedup_keep_first(t: ShopTables) -> DataFrame:
    return validate.keep_first(_order_lines(t), "order_line_id", _LINE_ORDER)


# ============================================================ loading L1-L8
_O = "orders"
_O_FINAL = final_columns_sql(_O)


def _orders_typed(t: ShopTables) -> DataFrame:
    """The orders table in its declared types (what a cleaner hands over)."""
    return load.align_columns(t.orders, spec_for(_O)).drop("_etl_loaded_at", "_etl_source")


@check(
    "load_high_water_mark",
    with_shop("SELECT max(created_at) AS high_water_mark FROM orders"),
)
def q_load_high_water_mark(t: ShopTables) -> DataFrame:
    return load.high_water_mark(t.orders)


@check(
    "load_filter_new_rows",
    with_shop(
        f"SELECT {_O_FINAL} FROM orders WHERE created_at > "
        f"(SELECT max(created_at) FROM orders WHERE created_at < {ts(CUT)})"
    ),
)
def q_load_filter_new_rows(t: ShopTables) -> DataFrame:
    typed = _orders_typed(t)
    wm = load.watermark_value(typed.filter(F.col("created_at") < ts_literal(CUT)))
    return load.filter_new_rows(typed, wm)


@check(
    "load_anti_existing",
    with_shop(
        f"SELECT {_O_FINAL} FROM orders n WHERE n.created_at >= {ts(OVERLAP_FROM)} AND NOT EXISTS "
        f"(SELECT 1 FROM orders o WHERE o.created_at < {ts(CUT)} AND o.order_id = n.order_id)"
    ),
)
def q_load_anti_existing(t: ShopTables) -> DataFrame:
    typed = _orders_typed(t)
    new = typed.filter(F.col("created_at") >= ts_literal(OVERLAP_FROM))
    target = typed.filter(F.col("created_at") < ts_literal(CUT))
    return load.anti_existing(new, target, "order_id")


@check(
    "load_align_columns",
    with_shop(
        "SELECT website_session_id, created_at, user_id, CAST(is_repeat_session AS BIGINT) AS is_repeat_session, "
        "utm_source, utm_campaign, CAST(NULL AS VARCHAR) AS utm_content, device_type, "
        "CAST(NULL AS VARCHAR) AS http_referer, CAST(NULL AS TIMESTAMP) AS _etl_loaded_at, "
        "CAST(NULL AS VARCHAR) AS _etl_source FROM website_sessions"
    ),
)
def q_load_align_columns(t: ShopTables) -> DataFrame:
    src = (
        t.website_sessions.drop("utm_content", "http_referer")
        .withColumn("user_id", F.col("user_id").cast("string"))
        .withColumn("extra_column", F.lit("ignored"))
    )
    return load.align_columns(src, spec_for(_S))


@check(
    "load_nan_to_null",
    with_shop(
        "SELECT order_id, CASE WHEN order_id % 11 = 0 THEN NULL "
        "ELSE CAST(price_usd AS DOUBLE) END AS price_usd FROM orders"
    ),
)
def q_load_nan_to_null(t: ShopTables) -> DataFrame:
    src = t.orders.select(
        "order_id",
        F.when(F.col("order_id") % 11 == 0, F.lit(float("nan")))
        .otherwise(F.col("price_usd").cast("double"))
        .alias("price_usd"),
    )
    return load.nan_to_null(src)


def _with_audit(df: DataFrame, table: str, run_ts: str) -> DataFrame:
    return clean.add_audit_columns(df, table, run_ts)


@check(
    "load_incremental_merge",
    with_shop(
        f"SELECT {_O_FINAL}, CASE WHEN created_at < {ts(CUT)} THEN {ts(RUN_TS_1)} "
        f"ELSE {ts(RUN_TS_2)} END AS _etl_loaded_at, 'orders' AS _etl_source FROM orders"
    ),
)
def q_load_incremental_merge(t: ShopTables) -> DataFrame:
    spark = t.spark
    target = scratch_path(spark, "load-orders")
    first = _with_audit(t.orders.filter(F.col("created_at") < ts_literal(CUT)), _O, RUN_TS_1)
    load.load_table(spark, first, _O, target)
    batch = _with_audit(t.orders, _O, RUN_TS_2)
    load.load_table(spark, batch, _O, target)
    again = load.load_table(spark, batch, _O, target)  # idempotent: appends nothing
    if again.rows_inserted != 0:
        raise AssertionError(f"re-run appended {again.rows_inserted} rows")
    return load.read_target(spark, target, spec_for(_O))


@check(
    "load_full_refresh",
    with_shop(
        "SELECT CAST(product_id AS BIGINT) AS product_id, created_at, product_name, "
        f"{ts(RUN_TS_2)} AS _etl_loaded_at, 'products' AS _etl_source FROM products"
    ),
)
def q_load_full_refresh(t: ShopTables) -> DataFrame:
    spark = t.spark
    target = scratch_path(spark, "load-products")
    stale = t.products.withColumn("product_name", F.concat("product_name", F.lit(" (old)")))
    load.load_table(spark, _with_audit(stale, "products", RUN_TS_1), "products", target)
    load.load_table(spark, _with_audit(t.products, "products", RUN_TS_2), "products", target)
    return load.read_target(spark, target, spec_for("products"))


def _export_dirty_csv(t: ShopTables) -> str:
    """Write the six corrupted raw tables as CSV landing files, compressed (concurrent
    jobs, one per table). The order lines, which three of them are built of, are numbered once."""
    from concurrent.futures import ThreadPoolExecutor

    folder = scratch_path(t.spark, "csv-src")
    t.store_lines()
    with ThreadPoolExecutor(max_workers=3) as pool:
        list(
            pool.map(
                lambda tb: csv_source.write_csv(_dirty(t, tb), csv_source.csv_path(folder, tb), "gzip"),
                TABLE_ORDER,
            )
        )
    return folder


def _kept_sql(table: str) -> str:
    return (
        f"kept_{table} AS (SELECT * FROM typed_{table} QUALIFY row_number() OVER "
        f"(PARTITION BY {spec_for(table).pk} ORDER BY _seq) = 1)"
    )


def _loaded_rows_sql(table: str) -> str:
    """Every cell of the loaded rows, as text: one list a row."""
    cells = ", ".join(f"coalesce(CAST({_final(f.name, f.dataType)} AS VARCHAR), '-')" for f in spec_for(table).schema.fields)
    return f"SELECT '{table}' AS table_name, CAST({spec_for(table).pk} AS BIGINT) AS key, concat_ws('|', {cells}) AS row_text FROM kept_{table}"


def _loaded_rows(df: DataFrame, table: str) -> DataFrame:
    cells = []
    for f in spec_for(table).schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        cells.append(F.coalesce(c.cast("string"), F.lit("-")))
    return df.select(F.lit(table).alias("table_name"), F.col(spec_for(table).pk).cast("bigint").alias("key"), F.concat_ws("|", *cells).alias("row_text"))


@check(
    "pipeline_end_to_end",
    with_shop(
        "\nUNION ALL\n".join(_loaded_rows_sql(tb) for tb in TABLE_ORDER),
        *[c for tb in TABLE_ORDER for c in clean_ctes(tb) + [_kept_sql(tb)]],
    ),
)
def q_pipeline_end_to_end(t: ShopTables) -> DataFrame:
    """Every row of the six loaded targets."""
    spark = t.spark
    src = _export_dirty_csv(t)
    target = scratch_path(spark, "pipeline-target")
    summary = run_pipeline(spark, src, target, run_ts=RUN_TS_1).collect()
    failed = [r for r in summary if r["status"] == "failed"]
    if failed:
        raise RuntimeError(f"pipeline failures: {failed}")
    loaded = read_loaded(spark, target)
    return _union([_loaded_rows(loaded[tb], tb) for tb in TABLE_ORDER])


def _summary_sql(table: str) -> str:
    """The counts by their definitions: rows scanned; less exact copies; text that casts to nothing; keys missing or
    not numeric; what is left; its repeated keys."""
    spec = spec_for(table)
    money = [c for c in spec.columns if c in NUMERIC_COLUMNS]
    lost = " + ".join(f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL(10,2)) IS NULL)" for c in money) or "0"
    key = _typed_expr(table, spec.pk)
    return (
        f"SELECT '{table}' AS table_name, '{spec.strategy}' AS strategy, 'loaded' AS status, CAST(0 AS BIGINT) AS malformed_rows, "
        f"(SELECT count(*) FROM dirty_{table}) AS rows_in, (SELECT count(*) FROM dirty_{table}) - count(*) AS exact_duplicates, "
        f"count(*) FILTER (WHERE created_at IS NOT NULL AND TRY_CAST(created_at AS TIMESTAMP) IS NULL) AS bad_dates, "
        f"{lost} AS bad_money, count(*) FILTER (WHERE {spec.pk} IS NULL) AS null_keys, "
        f"count(*) FILTER (WHERE {spec.pk} IS NOT NULL AND {key} IS NULL) AS bad_keys, count({key}) AS rows_clean, "
        f"count({key}) - count(DISTINCT {key}) AS duplicate_pks, count(DISTINCT {key}) AS rows_inserted FROM dedup_{table}"
    )


@check(
    "load_summary",
    with_shop(
        "\nUNION ALL\n".join(_summary_sql(tb) for tb in TABLE_ORDER),
        *[c for tb in TABLE_ORDER for c in clean_ctes(tb)],
    ),
)
def q_load_summary(t: ShopTables) -> DataFrame:
    spark = t.spark
    src = _export_dirty_csv(t)
    target = scratch_path(spark, "pipeline-target")
    summary = run_pipeline(spark, src, target, run_ts=RUN_TS_1)
    return summary.drop("watermark", "message", "seconds")


@check(
    "load_duplicate_batch",
    with_shop(
        "SELECT DISTINCT l_orderkey AS order_id, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS BIGINT) AS website_session_id, "
        "CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS BIGINT) AS primary_product_id, CAST(NULL AS BIGINT) AS items_purchased, "
        "min(CAST(l_extendedprice AS DOUBLE)) AS price_usd, CAST(NULL AS DOUBLE) AS cogs_usd "
        "FROM lineitem GROUP BY l_orderkey"
    ),
)
def q_load_duplicate_batch(t: ShopTables) -> DataFrame:
    """One batch that repeats most keys (every line as an "order"), loaded twice: each key once, its smallest row."""
    spark = t.spark
    target = scratch_path(spark, "load-repeats")
    lines = read_table(spark, t.sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").cast("decimal(10,2)").alias("price_usd")
    )
    for run_ts in (RUN_TS_1, RUN_TS_2):
        load.load_table(spark, _with_audit(lines, _O, run_ts), _O, target)
    return load.read_target(spark, target, spec_for(_O)).drop("_etl_loaded_at", "_etl_source")


@check(
    "load_create_target",
    with_shop(
        "\nUNION ALL\n".join(
            f"SELECT '{tb}' AS table_name, CAST({i} AS BIGINT) AS position, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS column_type, "
            f"(SELECT count(*) FROM {tb}) AS rows_loaded"
            for tb in TABLE_ORDER
            for i, f in enumerate(spec_for(tb).full_schema.fields)
        )
    ),
)
def q_load_create_target(t: ShopTables) -> DataFrame:
    """S7: targets created from their declarations, created again (kept), then loaded; their stored columns and rows.
    Tables are independent and run as concurrent jobs."""
    from concurrent.futures import ThreadPoolExecutor

    spark = t.spark

    def create_and_load(tb: str) -> DataFrame:
        target = scratch_path(spark, f"declared-{tb}")
        load.create_target(spark, target, spec_for(tb))
        load.create_target(spark, target, spec_for(tb))
        load.load_table(spark, _with_audit(t.table(tb), tb, RUN_TS_1), tb, target, unique_keys=True)
        stored = load.read_target(spark, target, None)
        columns = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type")) for i, f in enumerate(stored.schema.fields)])
        return stored.agg(F.count(F.lit(1)).alias("rows_loaded")).select(F.lit(tb).alias("table_name"), F.explode(columns).alias("c"), "rows_loaded").select("table_name", "c.*", "rows_loaded")

    with ThreadPoolExecutor(max_workers=3) as pool:
        parts = list(pool.map(create_and_load, TABLE_ORDER))
    return _union(parts)


@check(
    "view_sql",
    with_shop(
        "SELECT device_type, count(*) AS sessions, count(user_id) AS known_users FROM website_sessions "
        "WHERE is_repeat_session = 1 GROUP BY device_type"
    ),
)
def q_view_sql(t: ShopTables) -> DataFrame:
    """S8: SQL over the registered staging view."""
    staging.register_views(staging.stage_all(t.all()))
    return t.spark.sql(
        "SELECT device_type, count(*) AS sessions, count(user_id) AS known_users FROM stg_website_sessions "
        "WHERE is_repeat_session GROUP BY device_type"
    )


_MART_SQL = {
    "mrt_channel_performance": O.CHANNEL_PERFORMANCE,
    "mrt_product_profitability": O.PRODUCT_PROFITABILITY,
    "mrt_refund_rate_trends": O.REFUND_RATE_TRENDS,
    "mrt_order_value_trends": O.ORDER_VALUE_TRENDS,
    "mrt_cohort_retention": O.COHORT_RETENTION,
}


# per mart: key columns (as text), then the numbers
_MART_COLUMNS = {
    "mrt_channel_performance": (["utm_source", "utm_campaign"], ["sessions", "orders", "revenue", "conversion_rate_pct", "avg_order_value", "conversion_rank"]),
    "mrt_product_profitability": (
        ["product_name"],
        ["units_sold", "total_cogs", "gross_revenue", "gross_profit", "profit_margin_pct", "refund_count", "total_refund_amount", "profit_rank", "margin_rank"],
    ),
    "mrt_refund_rate_trends": (["refund_month", "product_name"], ["refunds", "units_sold_that_month", "refund_rate_pct", "rolling_3m_avg_refund_rate_pct"]),
    "mrt_order_value_trends": (["month"], ["sessions", "orders", "aov", "median_order_value", "monthly_revenue", "pct_multi_item", "revenue_per_session"]),
    "mrt_cohort_retention": (["cohort_month"], ["customers_in_cohort", *[f"month_{k}" for k in range(7)], "retention_m1_pct", "retention_m6_pct"]),
}


def _mart_row(name: str, text: str) -> str:
    """Select list of one mart's rows in the common shape of all marts."""
    keys, numbers = _MART_COLUMNS[name]
    wide = max(len(n) for _, n in _MART_COLUMNS.values())
    values = [f"CAST({c} AS DOUBLE) AS n{i}" for i, c in enumerate(numbers)] + [f"CAST(NULL AS DOUBLE) AS n{i}" for i in range(len(numbers), wide)]
    return f"'{name}' AS mart, concat_ws('|', {', '.join(f'CAST({k} AS {text})' for k in keys)}) AS key, " + ", ".join(values)


@check(
    "mart_materialize",
    "\nUNION ALL\n".join(f"SELECT {_mart_row(name, 'VARCHAR')} FROM ({sql})" for name, sql in _MART_SQL.items()),
)
def q_mart_materialize(t: ShopTables) -> DataFrame:
    """Every row of the written marts."""
    spark = t.spark
    out = scratch_path(spark, "marts")
    paths = marts.materialize(spark, t.all(), out, since=O.SINCE, min_sessions=O.MIN_SESSIONS)
    parts = []
    for name, p in paths.items():
        spark.read.parquet(p).createOrReplaceTempView(f"written_{name}")
        parts.append(spark.sql(f"SELECT {_mart_row(name, 'STRING')} FROM written_{name}"))
    return _union(parts)


@check(
    "mart_ordered",
    "SELECT row_number() OVER (ORDER BY refund_month DESC, product_name) AS position, refund_month, product_name, refunds "
    "FROM (" + O.REFUND_RATE_TRENDS + ")",
)
def q_mart_ordered(t: ShopTables) -> DataFrame:
    """O1: a mart in its display order, its positions made a column."""
    built = marts.build_marts(t.all(), since=O.SINCE, min_sessions=O.MIN_SESSIONS)
    return marts.with_positions(built["mrt_refund_rate_trends"], "mrt_refund_rate_trends").select("position", "refund_month", "product_name", "refunds")


# CSV scan: NA tokens injected into text columns (fixed rule values).
_NA_RULES = (("utm_source", 13, "NULL"), ("device_type", 17, "nan"), ("utm_campaign", 19, "N/A"))


def _csv_roundtrip_sql() -> str:
    rules = {c: m for c, m, _tok in _NA_RULES}
    cols = []
    for c in spec_for(_S).columns:
        if c in rules:
            cols.append(f"CASE WHEN website_session_id % {rules[c]} = 0 THEN NULL ELSE {c} END AS {c}")
        else:
            cols.append(f"CAST({c} AS VARCHAR) AS {c}")
    return "SELECT " + ", ".join(cols) + " FROM website_sessions"


@check("csv_scan_roundtrip", with_shop(_csv_roundtrip_sql()))
def q_csv_scan_roundtrip(t: ShopTables) -> DataFrame:
    src = t.website_sessions.select(
        *[F.col(c).cast("string").alias(c) for c in spec_for(_S).columns]
    )
    for c, m, token in _NA_RULES:
        src = src.withColumn(
            c, F.when(F.col("website_session_id") % m == 0, F.lit(token)).otherwise(F.col(c))
        )
    from ledgerline.sources.dirty import messy_header

    path = scratch_path(t.spark, "csv-roundtrip")
    csv_source.write_csv(src.toDF(*[messy_header(c) for c in src.columns]), path)
    return clean.normalize_columns(csv_source.read_csv(t.spark, path))


@check(
    "csv_scan_quoted",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN text || suffix IN ('NULL') THEN NULL ELSE '\"' || replace(text, 'e', ',\"') || '\\' || chr(10) || suffix END AS body "
    "FROM (SELECT doc_id, text, CAST(doc_id % 7 AS VARCHAR) AS suffix FROM documents)",
)
def q_csv_scan_quoted(t: ShopTables) -> DataFrame:
    """Whole texts with commas, quotes, backslashes and newlines, written as standard CSV, scanned back."""
    docs = read_table(t.spark, t.sf_dir, "documents")
    suffix = (F.col("doc_id") % 7).cast("string")
    body = F.concat(F.lit('"'), F.replace("text", F.lit("e"), F.lit(',"')), F.lit("\\\n"), suffix)
    path = scratch_path(t.spark, "csv-quoted")
    csv_source.write_csv(docs.select(F.col("doc_id").cast("string").alias("doc_id"), body.alias("body")), path)
    return csv_source.read_csv(t.spark, path, multiline=True)


# ============================================================ verification
def _profile_sql(table: str, what: str) -> str:
    return f"SELECT '{table}' AS table_name, {what} FROM {table}"


@check(
    "row_counts",
    with_shop("\nUNION ALL\n".join(_profile_sql(tb, "count(*) AS row_count") for tb in TABLE_ORDER)),
)
def q_row_counts(t: ShopTables) -> DataFrame:
    return quality.row_counts(t.all())


@check(
    "null_pk_counts",
    with_shop(
        "\nUNION ALL\n".join(
            _profile_sql(
                tb,
                f"'{spec_for(tb).pk}' AS pk_column, "
                f"count(*) FILTER (WHERE {spec_for(tb).pk} IS NULL) AS null_pk_count",
            )
            for tb in TABLE_ORDER
        )
    ),
)
def q_null_pk_counts(t: ShopTables) -> DataFrame:
    return quality.null_pk_counts(t.all())


@check(
    "date_ranges",
    with_shop(
        "\nUNION ALL\n".join(
            _profile_sql(
                tb,
                "CAST(min(created_at) AS DATE) AS min_date, CAST(max(created_at) AS DATE) AS max_date",
            )
            for tb in quality.DATE_RANGE_TABLES
        )
    ),
)
def q_date_ranges(t: ShopTables) -> DataFrame:
    return quality.date_ranges(t.all())


@check(
    "sample_orders",
    with_shop(
        "SELECT order_id, CAST(created_at AS DATE) AS order_date, CAST(price_usd AS DOUBLE) AS price_usd, "
        "CAST(items_purchased AS BIGINT) AS items_purchased FROM orders ORDER BY order_id LIMIT 5"
    ),
)
def q_sample_orders(t: ShopTables) -> DataFrame:
    return quality.sample_rows(t.orders)


def _schema_test_sql(table: str) -> str:
    pk = spec_for(table).pk
    m = f"stg_{table}"
    return (
        f"SELECT '{m}' AS model, '{pk}' AS column_name, 'unique' AS test, "
        f"(SELECT count(*) FROM (SELECT {pk} FROM {table} WHERE {pk} IS NOT NULL "
        f"GROUP BY {pk} HAVING count(*) > 1)) AS failures\n"
        f"UNION ALL SELECT '{m}', '{pk}', 'not_null', "
        f"(SELECT count(*) FROM {table} WHERE {pk} IS NULL)"
    )


@check(
    "dq_schema_tests",
    with_shop(
        "SELECT model, column_name, test, failures, "
        "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n"
        + "\nUNION ALL\n".join(_schema_test_sql(tb) for tb in TABLE_ORDER)
        + ")"
    ),
)
def q_dq_schema_tests(t: ShopTables) -> DataFrame:
    return quality.schema_tests(staging.stage_all(t.all()))


@check(
    "dq_unique_violations",
    with_shop(
        "SELECT order_line_id AS value, count(*) AS occurrences FROM order_lines "
        "WHERE order_line_id IS NOT NULL GROUP BY order_line_id HAVING count(*) > 1",
        _ORDER_LINES_SQL,
    ),
)
def q_dq_unique_violations(t: ShopTables) -> DataFrame:
    return quality.unique_violations(_order_lines(t), "order_line_id")


@check(
    "dq_not_null_violations",
    with_shop(
        "SELECT website_session_id, created_at, user_id, "
        "CASE WHEN is_repeat_session = 1 THEN true ELSE false END AS is_repeat_session, "
        "utm_source, utm_campaign, utm_content, device_type, http_referer "
        "FROM website_sessions WHERE user_id IS NULL"
    ),
)
def q_dq_not_null_violations(t: ShopTables) -> DataFrame:
    return quality.not_null_violations(staging.stg_website_sessions(t.website_sessions), "user_id")


# ============================================================ primitives
@check(
    "filter_since",
    with_shop(
        f"SELECT website_session_id, created_at FROM website_sessions WHERE created_at >= {ts(O.SINCE)}"
    ),
)
def q_filter_since(t: ShopTables) -> DataFrame:
    return t.website_sessions.filter(F.col("created_at") >= ts_literal(O.SINCE)).select(
        "website_session_id", "created_at"
    )


@check(
    "filter_not_null",
    with_shop("SELECT website_session_id, user_id FROM website_sessions WHERE user_id IS NOT NULL"),
)
def q_filter_not_null(t: ShopTables) -> DataFrame:
    return t.website_sessions.filter(F.col("user_id").isNotNull()).select(
        "website_session_id", "user_id"
    )


@check(
    "having_min_sessions",
    with_shop(
        "SELECT coalesce(utm_source, 'direct') AS utm_source, "
        "CAST(date_trunc('month', created_at) AS DATE) AS month, "
        "count(DISTINCT website_session_id) AS sessions FROM website_sessions "
        f"GROUP BY 1, 2 HAVING count(DISTINCT website_session_id) > {O.MIN_SESSIONS}"
    ),
)
def q_having_min_sessions(t: ShopTables) -> DataFrame:
    return (
        t.website_sessions.groupBy(
            F.coalesce(F.col("utm_source"), F.lit("direct")).alias("utm_source"),
            month_start("created_at").alias("month"),
        )
        .agg(F.count("website_session_id").alias("sessions"))
        .filter(F.col("sessions") > O.MIN_SESSIONS)
    )


@check(
    "case_segment",
    with_shop(
        "SELECT website_session_id, CASE WHEN is_repeat_session = 0 THEN 'First-Time Visitor' "
        "WHEN is_repeat_session = 1 AND user_id IS NULL THEN 'Repeat Guest' "
        "ELSE 'Repeat Registered' END AS customer_type FROM website_sessions"
    ),
)
def q_case_segment(t: ShopTables) -> DataFrame:
    return t.website_sessions.select(
        "website_session_id", reports.customer_segment().alias("customer_type")
    )


@check(
    "join_left_sessions_orders",
    with_shop(
        "SELECT s.website_session_id, o.order_id, CAST(o.price_usd AS DOUBLE) AS price_usd "
        "FROM website_sessions s LEFT JOIN orders o ON s.website_session_id = o.website_session_id"
    ),
)
def q_join_left_sessions_orders(t: ShopTables) -> DataFrame:
    return t.website_sessions.select("website_session_id").join(
        t.orders.select("website_session_id", "order_id", "price_usd"),
        "website_session_id",
        "left",
    )


@check(
    "join_inner_items_refunds",
    with_shop(
        "SELECT oi.order_item_id, CAST(oi.product_id AS BIGINT) AS product_id, r.order_item_refund_id, "
        "CAST(r.refund_amount_usd AS DOUBLE) AS refund_amount_usd "
        "FROM order_items oi JOIN order_item_refunds r ON oi.order_item_id = r.order_item_id"
    ),
)
def q_join_inner_items_refunds(t: ShopTables) -> DataFrame:
    return t.order_items.select("order_item_id", "product_id").join(
        t.order_item_refunds.select("order_item_id", "order_item_refund_id", "refund_amount_usd"),
        "order_item_id",
    )


@check(
    "join_three_way",
    with_shop(
        "SELECT r.order_item_refund_id, p.product_name, r.created_at AS refund_created_at "
        "FROM order_item_refunds r JOIN order_items oi ON r.order_item_id = oi.order_item_id "
        "JOIN products p ON oi.product_id = p.product_id"
    ),
)
def q_join_three_way(t: ShopTables) -> DataFrame:
    r = t.order_item_refunds.select(
        "order_item_refund_id", "order_item_id", F.col("created_at").alias("refund_created_at")
    )
    return (
        r.join(t.order_items.select("order_item_id", "product_id"), "order_item_id")
        .join(t.products.select("product_id", "product_name"), "product_id")
        .select("order_item_refund_id", "product_name", "refund_created_at")
    )


@check(
    "join_left_two_keys",
    with_shop(
        "SELECT CAST(mon AS DATE) AS month, pname AS product_name, units AS units_sold_that_month, "
        "n_ref AS refunds FROM name_months",
        *O.REFUND_RATE_TRENDS_CTES[:2],
    ),
)
def q_join_left_two_keys(t: ShopTables) -> DataFrame:
    return reports.monthly_sales_and_refunds(
        t.order_items, t.order_item_refunds, t.products, since=O.SINCE
    )


@check(
    "join_first_purchase",
    with_shop(
        "SELECT o.order_id, o.user_id, f.first_order_at FROM orders o JOIN "
        "(SELECT user_id, min(created_at) AS first_order_at FROM orders WHERE user_id IS NOT NULL "
        "GROUP BY user_id) f ON o.user_id = f.user_id"
    ),
)
def q_join_first_purchase(t: ShopTables) -> DataFrame:
    return reports.first_purchase_join(t.orders).select("order_id", "user_id", "first_order_at")


_MONTH = "CAST(date_trunc('month', created_at) AS DATE)"


@check(
    "agg_count_distinct",
    with_shop(
        f"SELECT {_MONTH} AS month, count(DISTINCT user_id) AS customers, "
        "count(DISTINCT primary_product_id) AS lead_products FROM orders GROUP BY 1"
    ),
)
def q_agg_count_distinct(t: ShopTables) -> DataFrame:
    return t.orders.groupBy(month_start("created_at").alias("month")).agg(
        F.count_distinct("user_id").alias("customers"),
        F.count_distinct("primary_product_id").alias("lead_products"),
    )


@check(
    "agg_conditional_distinct",
    with_shop(
        f"SELECT {_MONTH} AS month, "
        "count(DISTINCT CASE WHEN items_purchased = 1 THEN user_id END) AS single_item_customers, "
        "count(DISTINCT CASE WHEN items_purchased > 1 THEN user_id END) AS multi_item_customers "
        "FROM orders GROUP BY 1"
    ),
)
def q_agg_conditional_distinct(t: ShopTables) -> DataFrame:
    return t.orders.groupBy(month_start("created_at").alias("month")).agg(
        F.count_distinct(F.when(F.col("items_purchased") == 1, F.col("user_id"))).alias(
            "single_item_customers"
        ),
        F.count_distinct(F.when(F.col("items_purchased") > 1, F.col("user_id"))).alias(
            "multi_item_customers"
        ),
    )


@check(
    "agg_sum",
    with_shop(
        "SELECT CAST(product_id AS BIGINT) AS product_id, CAST(sum(price_usd) AS DOUBLE) AS revenue, "
        "CAST(sum(cogs_usd) AS DOUBLE) AS cogs FROM order_items GROUP BY product_id"
    ),
)
def q_agg_sum(t: ShopTables) -> DataFrame:
    return t.order_items.groupBy("product_id").agg(
        F.sum("price_usd").alias("revenue"), F.sum("cogs_usd").alias("cogs")
    )


@check(
    "agg_avg",
    with_shop(
        f"SELECT {_MONTH} AS month, {R('avg(items_purchased)', 4)} AS avg_items, "
        f"{R('avg(price_usd)', 4)} AS avg_price FROM orders GROUP BY 1"
    ),
)
def q_agg_avg(t: ShopTables) -> DataFrame:
    from ledgerline.functions.numeric import exact_mean

    g = t.orders.groupBy(month_start("created_at").alias("month")).agg(
        F.sum("items_purchased").alias("_i"),
        F.count("items_purchased").alias("_in"),
        F.sum("price_usd").alias("_p"),
        F.count("price_usd").alias("_pn"),
    )
    return g.select(
        "month",
        round_half_up(exact_mean("_i", "_in"), 4).alias("avg_items"),
        round_half_up(exact_mean("_p", "_pn"), 4).alias("avg_price"),
    )


@check(
    "agg_median",
    with_shop(
        "SELECT p.product_name, "
        + R("percentile_cont(0.5) WITHIN GROUP (ORDER BY CAST(oi.price_usd AS DOUBLE))", 2)
        + " AS median_item_price FROM order_items oi JOIN products p ON oi.product_id = p.product_id "
        "GROUP BY p.product_name"
    ),
)
def q_agg_median(t: ShopTables) -> DataFrame:
    items = t.order_items.select("product_id", "price_usd").join(
        t.products.select("product_id", "product_name"), "product_id"
    )
    med = stored_median(items, ["product_name"], "price_usd", "_m")
    return med.select("product_name", round_half_up("_m", 2).alias("median_item_price"))


@check(
    "window_rank",
    with_shop(
        "SELECT CAST(product_id AS BIGINT) AS product_id, CAST(revenue AS DOUBLE) AS revenue, "
        "rank() OVER (ORDER BY revenue DESC NULLS FIRST) AS revenue_rank FROM "
        "(SELECT p.product_id, sum(oi.price_usd) AS revenue FROM products p "
        "LEFT JOIN order_items oi ON p.product_id = oi.product_id GROUP BY p.product_id)"
    ),
)
def q_window_rank(t: ShopTables) -> DataFrame:
    rev = t.order_items.groupBy("product_id").agg(F.sum("price_usd").alias("revenue"))
    base = t.products.select("product_id").join(rev, "product_id", "left")
    return stored_ranks(base, [RankSpec(F.col("revenue"), "revenue_rank", True, True)])


@check(
    "window_rolling_avg",
    with_shop(
        "SELECT CAST(mon AS DATE) AS month, pname AS product_name, units AS units_sold_that_month, "
        + R("avg(units) OVER (PARTITION BY pname ORDER BY mon ROWS 2 PRECEDING)", 4)
        + " AS rolling_3_units FROM name_months",
        *O.REFUND_RATE_TRENDS_CTES[:2],
    ),
)
def q_window_rolling_avg(t: ShopTables) -> DataFrame:
    from pyspark.sql import Window

    combined = reports.monthly_sales_and_refunds(
        t.order_items, t.order_item_refunds, t.products, since=O.SINCE
    )
    w = Window.partitionBy("product_name").orderBy("month").rowsBetween(-2, 0)
    return combined.select(
        "month",
        "product_name",
        "units_sold_that_month",
        round_half_up(F.avg(F.col("units_sold_that_month").cast("decimal(20,0)")).over(w), 4).alias(
            "rolling_3_units"
        ),
    )


@check(
    "scalar_coalesce_nullif",
    with_shop(
        "SELECT website_session_id, coalesce(utm_source, 'direct') AS utm_source, "
        "coalesce(utm_campaign, 'organic') AS utm_campaign, "
        "nullif(device_type, 'desktop') AS mobile_only, "
        + R("100.0 * is_repeat_session / nullif(CAST(website_session_id % 4 AS BIGINT), 0)", 2)
        + " AS guarded_ratio FROM website_sessions"
    ),
)
def q_scalar_coalesce_nullif(t: ShopTables) -> DataFrame:
    s = t.website_sessions
    return s.select(
        "website_session_id",
        F.coalesce(F.col("utm_source"), F.lit("direct")).alias("utm_source"),
        F.coalesce(F.col("utm_campaign"), F.lit("organic")).alias("utm_campaign"),
        F.nullif(F.col("device_type"), F.lit("desktop")).alias("mobile_only"),
        pct_rounded(F.col("is_repeat_session"), F.col("website_session_id") % 4).alias(
            "guarded_ratio"
        ),
    )


@check(
    "scalar_round_half_up",
    with_shop(
        "SELECT order_item_id, "
        + R("cogs_usd", 0)
        + " AS cogs_0, "
        + R("cogs_usd", 2)
        + " AS cogs_2, "
        + R("100.0 * cogs_usd / nullif(price_usd, 0)", 2)
        + " AS cogs_pct FROM order_items"
    ),
)
def q_scalar_round_half_up(t: ShopTables) -> DataFrame:
    from ledgerline.functions.numeric import pct

    i = t.order_items
    return i.select(
        "order_item_id",
        round_half_up("cogs_usd", 0).alias("cogs_0"),
        round_half_up("cogs_usd", 2).alias("cogs_2"),
        round_half_up(pct("cogs_usd", "price_usd"), 2).alias("cogs_pct"),
    )


@check(
    "scalar_month_trunc",
    with_shop(f"SELECT order_id, {_MONTH} AS month FROM orders"),
)
def q_scalar_month_trunc(t: ShopTables) -> DataFrame:
    return t.orders.select("order_id", month_start("created_at").alias("month"))


@check(
    "scalar_month_index",
    with_shop(
        "SELECT order_item_refund_id, (year(f.created_at) - year(i.created_at)) * 12 "
        "+ month(f.created_at) - month(i.created_at) AS months_to_refund "
        "FROM order_item_refunds f JOIN order_items i USING (order_item_id)"
    ),
)
def q_scalar_month_index(t: ShopTables) -> DataFrame:
    r = t.order_item_refunds.select(
        "order_item_refund_id", "order_item_id", month_start("created_at").alias("_rm")
    )
    i = t.order_items.select("order_item_id", month_start("created_at").alias("_om"))
    return r.join(i, "order_item_id").select(
        "order_item_refund_id", month_index("_rm", "_om").alias("months_to_refund")
    )


def queries(finalize: Callable[[DataFrame], DataFrame], tables) -> dict:
    out = {}
    for key, (fn, _sql) in CHECKS.items():
        def run(spark: SparkSession, sf_dir: str, fn=fn) -> DataFrame:
            return finalize(fn(tables(spark, sf_dir)))

        run.__name__ = key
        out[key] = run
    return out


def oracles() -> dict[str, str]:
    return {k: sql for k, (_fn, sql) in CHECKS.items() if sql is not None}


# ============================================================ streaming load
@check(
    "stream_incremental_load",
    with_shop(
        f"SELECT {_O_FINAL}, CASE WHEN created_at < {ts(CUT)} THEN {ts(RUN_TS_1)} "
        f"ELSE {ts(RUN_TS_2)} END AS _etl_loaded_at, 'orders' AS _etl_source FROM orders"
    ),
)
def q_stream_incremental_load(t: ShopTables) -> DataFrame:
    """Two landings of order files, each consumed by an availableNow run of
    the streaming loader: the first holds orders before the cut, the second
    all orders again (overlap); the target ends with every order once."""
    from ledgerline.streaming.continuous_load import landing_schema, run_available

    spark = t.spark
    landing = scratch_path(spark, "landing-orders")
    target = scratch_path(spark, "stream-target-orders")
    ckpt = scratch_path(spark, "stream-ckpt-orders")
    as_text = t.orders.select(*[F.col(c).cast("string").alias(c) for c in spec_for(_O).columns])
    as_text.filter(F.col("created_at") < F.lit(CUT)).write.mode("append").option(
        "header", True
    ).csv(landing)
    schema = landing_schema(spark, landing)
    run_available(spark, landing, _O, target, RUN_TS_1, schema, ckpt)
    as_text.write.mode("append").option("header", True).csv(landing)
    run_available(spark, landing, _O, target, RUN_TS_2, schema, ckpt)
    return load.read_target(spark, target, spec_for(_O))
