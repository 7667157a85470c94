"""M2-M5 on a shop small enough to count by hand; the DuckDB oracles are held to the same numbers."""

import datetime as dt
import re

import duckdb
import pytest

from ledgerline.operators import reports
from ledgerline.plans import oracle_sql as O
from tests.fixtures import frame, money

PRODUCTS = [(1, "ant"), (2, "bee"), (3, "cow")]
# order, buyer, time, items, price
ORDERS = [
    (1, 10, "1996-01-05", 1, 10),
    (2, 10, "1996-02-05", 2, 30),
    (3, 11, "1996-02-09", 1, 20),
    (4, None, "1996-02-20", 1, 70),
    (5, 11, "1996-08-01", 3, 15),
]
# item, order, time, product, price, cost
ITEMS = [
    (101, 1, "1996-01-05", 1, 10, 4),
    (201, 2, "1996-02-05", 1, 10, 4),
    (202, 2, "1996-02-05", 2, 20, 15),
    (301, 3, "1996-02-09", 2, 20, 15),
    (401, 4, "1996-03-01", 1, 10, 4),
]
# refund, time, item, amount
REFUNDS = [(901, "1996-02-10", 201, 10), (902, "1996-02-11", 202, 5), (903, "1996-05-01", 101, 10)]
SESSIONS = [(1001, "1996-01-01"), (1002, "1996-02-01"), (1003, "1996-02-02"), (1004, "1996-02-03")]

day = dt.date


def month(m):
    return day(1996, m, 1)


@pytest.fixture(scope="module")
def shop(spark):
    ts = lambda x: dt.datetime.fromisoformat(x)
    return {
        "products": frame(spark, "products", [{"product_id": i, "product_name": n} for i, n in PRODUCTS]),
        "orders": frame(spark, "orders", [{"order_id": o, "user_id": u, "created_at": ts(t), "items_purchased": n, "price_usd": money(p)} for o, u, t, n, p in ORDERS]),
        "order_items": frame(spark, "order_items", [{"order_item_id": i, "order_id": o, "created_at": ts(t), "product_id": p, "price_usd": money(x), "cogs_usd": money(c)} for i, o, t, p, x, c in ITEMS]),
        "order_item_refunds": frame(spark, "order_item_refunds", [{"order_item_refund_id": r, "created_at": ts(t), "order_item_id": i, "refund_amount_usd": money(a)} for r, t, i, a in REFUNDS]),
        "website_sessions": frame(spark, "website_sessions", [{"website_session_id": s, "created_at": ts(t)} for s, t in SESSIONS]),
    }


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    create = lambda name, columns, rows: (con.execute(f"create table {name} ({columns})"), con.executemany(f"insert into {name} values ({','.join('?' * len(rows[0]))})", rows))
    create("products", "product_id int, product_name varchar", PRODUCTS)
    create("orders", "order_id bigint, user_id bigint, created_at timestamp, items_purchased int, price_usd decimal(12,2)", ORDERS)
    create("order_items", "order_item_id bigint, order_id bigint, created_at timestamp, product_id int, price_usd decimal(12,2), cogs_usd decimal(16,4)", ITEMS)
    create("order_item_refunds", "order_item_refund_id bigint, created_at timestamp, order_item_id bigint, refund_amount_usd decimal(12,2)", REFUNDS)
    create("website_sessions", "website_session_id bigint, created_at timestamp", SESSIONS)
    return con


def oracle(con, sql, columns):
    """The report part of an oracle, over the tables above instead of the derived ones."""
    derived = ",\n".join(O.SHOP_CTES)
    assert derived in sql
    sql = re.sub(r"WITH ,\n", "WITH ", sql.replace(derived, ""))
    return sorted(con.sql(f"select {columns} from ({sql})").fetchall(), key=str)


def spark_rows(df, columns):
    out = []
    for r in df.select(*columns.split(", ")).collect():
        out.append(tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r))
    return sorted(out, key=str)


def same(got, want):
    assert [tuple(float(v) if isinstance(v, (int, float)) else v for v in r) for r in got] == [tuple(float(v) if isinstance(v, (int, float)) else v for v in r) for r in want]


def test_m2(shop, duck):
    c = "product_name, units_sold, gross_revenue, gross_profit, profit_margin_pct, refund_count, total_refund_amount, refund_rate_of_revenue_pct, profit_rank, margin_rank"
    # ant: 3 sold for 30, cost 12; two refunds of 10. bee: 2 for 40, cost 30; one refund of 5. cow: never sold, ranks first
    want = [("ant", 3, 30, 18, 60, 2, 20, 66.67, 2, 2), ("bee", 2, 40, 10, 25, 1, 5, 12.5, 3, 3), ("cow", 0, None, None, None, 0, 0, None, 1, 1)]
    same(spark_rows(reports.product_profitability(shop["products"], shop["order_items"], shop["order_item_refunds"]), c), want)
    same(oracle(duck, O.PRODUCT_PROFITABILITY, c), want)


def test_m3(shop, duck):
    c = "refund_month, product_name, refunds, units_sold_that_month, refund_rate_pct, rolling_3m_avg_refund_rate_pct"
    # the May refund of ant falls in a month without sales and is not shown
    want = [(month(1), "ant", 0, 1, 0, 0), (month(2), "ant", 1, 1, 100, 50), (month(2), "bee", 1, 2, 50, 50), (month(3), "ant", 0, 1, 0, 33.33)]
    same(spark_rows(reports.refund_rate_trends(shop["order_items"], shop["order_item_refunds"], shop["products"], since="1996-01-01"), c), want)
    same(oracle(duck, O.REFUND_RATE_TRENDS, c), want)


def test_m4(shop, duck):
    c = "month, sessions, orders, avg_items_per_order, aov, median_order_value, monthly_revenue, single_item_orders, multi_item_orders, pct_multi_item, revenue_per_session"
    # February: 30, 20, 70; August has no sessions
    want = [(month(1), 1, 1, 1, 10, 10, 10, 1, 0, 0, 10), (month(2), 3, 3, 1.33, 40, 30, 120, 2, 1, 33.33, 40), (month(8), None, 1, 3, 15, 15, 15, 0, 1, 100, None)]
    same(spark_rows(reports.order_value_trends(shop["orders"], shop["website_sessions"]), c), want)
    same(oracle(duck, O.ORDER_VALUE_TRENDS, c), want)
    c = "month, orders, median_order_value"
    want = [(month(1), 1, 10), (month(2), 3, 30), (month(8), 1, 15)]
    same(spark_rows(reports.order_value_trends_orders_only(shop["orders"]), c), want)
    same(oracle(duck, O.ORDER_VALUE_TRENDS_ORDERS_ONLY, c), want)


def test_m5(shop, duck):
    c = "cohort_month, customers_in_cohort, month_0, month_1, month_6, retention_m1_pct, retention_m6_pct"
    # buyer 10 starts in January and is back in February; buyer 11 starts in February and is back in August
    want = [(month(1), 1, 1, 1, 0, 100, 0), (month(2), 1, 1, 0, 1, 0, 100)]
    same(spark_rows(reports.cohort_retention(shop["orders"]), c), want)
    same(oracle(duck, O.COHORT_RETENTION, c), want)
