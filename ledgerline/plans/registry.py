"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Inputs are always the given test tables (through ``sources.testdata``), so a
query's work grows with them. Every result passes through ``finalize`` so its
column types match the SQL oracle: integral -> bigint, decimal -> double.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import reports, staging
from ledgerline.plans import oracle_sql as O
from ledgerline.sources.testdata import shop_tables

Query = Callable[[SparkSession, str], DataFrame]

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def finalize(df: DataFrame) -> DataFrame:
    """Pin result types: integral -> bigint, decimal/float -> double."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _INTEGRAL):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _q(fn: Callable[..., DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(fn(shop_tables(spark, sf_dir)))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _staging(table: str) -> Query:
    return _q(lambda t: staging.STAGING[table](t.table(table)))


QUERIES: dict[str, Query] = {
    # staging views (ST1-ST6)
    **{f"stg_{t}": _staging(t) for t in staging.STAGING},
    # reports (M1-M7)
    "channel_performance": _q(
        lambda t: reports.channel_performance(
            t.website_sessions, t.orders, since=O.SINCE, min_sessions=O.MIN_SESSIONS
        )
    ),
    "product_profitability": _q(
        lambda t: reports.product_profitability(t.products, t.order_items, t.order_item_refunds)
    ),
    "refund_rate_trends": _q(
        lambda t: reports.refund_rate_trends(
            t.order_items, t.order_item_refunds, t.products, since=O.SINCE
        )
    ),
    "order_value_trends": _q(lambda t: reports.order_value_trends(t.orders, t.website_sessions)),
    "order_value_trends_orders_only": _q(
        lambda t: reports.order_value_trends_orders_only(t.orders)
    ),
    "revenue_per_session": _q(
        lambda t: reports.revenue_per_session(t.website_sessions, t.orders)
    ),
    "cohort_retention": _q(lambda t: reports.cohort_retention(t.orders)),
    "cohort_retention_long": _q(lambda t: reports.cohort_retention_long(t.orders)),
    "visitor_segments": _q(
        lambda t: reports.visitor_segments(t.website_sessions, t.orders, since=O.SINCE)
    ),
    "conversion_for_period": _q(
        lambda t: reports.conversion_for_period(
            t.website_sessions, t.orders, start=O.PERIOD[0], end=O.PERIOD[1]
        )
    ),
}


def _all_queries() -> dict[str, Query]:
    from ledgerline.plans import checks

    out = dict(QUERIES)
    out.update(checks.queries(finalize, shop_tables))
    return out


def queries() -> dict[str, Query]:
    return _all_queries()


def oracles() -> dict[str, str]:
    from ledgerline.plans import checks

    out = {k: v for k, v in O.all_oracles().items() if k in QUERIES}
    out.update(checks.oracles())
    return out
