"""Report semantics on hand-written edge fixtures (FIXTURES.md §C)."""

import statistics

from ledgerline.operators import reports
from tests.fixtures import frame, item, order, product, refund, session


def _rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


# ------------------------------------------------------------------ M1
def test_channel_having_is_strict_and_nulls_default(spark):
    sessions = []
    sid = 0
    # 100 sessions of (a, x): excluded by HAVING > 100
    for _ in range(100):
        sid += 1
        sessions.append(session(sid, "2014-01-02 00:00:00", source="a", campaign="x"))
    # 101 sessions with NULL source/campaign -> direct/organic, kept, no orders
    for _ in range(101):
        sid += 1
        sessions.append(session(sid, "2014-01-02 00:00:00"))
    # 150 sessions of (b, y), 3 orders on the first session, 1 on another
    first_b = sid + 1
    for _ in range(150):
        sid += 1
        sessions.append(session(sid, "2014-01-02 00:00:00", source="b", campaign="y"))
    # an old session of (b, y) that the since filter removes
    sessions.append(session(9999, "2012-12-31 23:59:59", source="b", campaign="y"))
    orders = [
        order(1, "2014-01-02 00:00:00", sid=first_b, price=10.005),
        order(2, "2014-01-02 00:00:00", sid=first_b, price=20.0),
        order(3, "2014-01-02 00:00:00", sid=first_b + 1, price=30.0),
        order(4, "2014-01-02 00:00:00", sid=9999, price=1000.0),
    ]
    out = reports.channel_performance(
        frame(spark, "website_sessions", sessions), frame(spark, "orders", orders)
    )
    got = _rows(out, "utm_source")
    assert set(got) == {"direct", "b"}
    d = got["direct"]
    assert d["utm_campaign"] == "organic" and d["sessions"] == 101 and d["orders"] == 0
    assert d["revenue"] is None and d["avg_order_value"] is None
    assert d["conversion_rate_pct"] == 0.0
    b = got["b"]
    assert b["sessions"] == 150 and b["orders"] == 3
    assert b["revenue"] == 60.0 and b["total_revenue"] == 60.0  # 60.01 rounded to 0 digits
    assert b["conversion_rate_pct"] == 2.0
    assert b["avg_order_value"] == 20.0  # 60.01 / 3 = 20.0033
    assert b["conversion_rank"] == 1 and d["conversion_rank"] == 2


# ------------------------------------------------------------------ M2
def test_profitability_null_revenue_ranks_first_and_ties(spark):
    products = [product(1, "A"), product(2, "B"), product(3, "C"), product(4, "D"), product(5, "Z")]
    items = [
        item(10, "2014-01-01 00:00:00", 1, 1, 100.0, 40.0),
        item(11, "2014-01-01 00:00:00", 1, 2, 100.0, 40.0),  # ties with product 1
        item(12, "2014-01-01 00:00:00", 2, 3, 50.0, 45.0),
        item(13, "2014-01-01 00:00:00", 3, 4, 0.0, 0.0),  # zero revenue -> NULL margin
    ]
    refunds = [refund(100, "2014-02-01 00:00:00", 10, 1, 25.0)]
    out = reports.product_profitability(
        frame(spark, "products", products),
        frame(spark, "order_items", items),
        frame(spark, "order_item_refunds", refunds),
    )
    got = _rows(out, "product_name")
    z = got["Z"]  # no sales
    assert z["units_sold"] == 0 and z["gross_revenue"] is None and z["profit_rank"] == 1
    assert z["margin_rank"] == 1 and z["refund_count"] == 0 and z["total_refund_amount"] == 0.0
    assert got["A"]["profit_rank"] == got["B"]["profit_rank"] == 2
    assert got["C"]["profit_rank"] == 4 and got["D"]["profit_rank"] == 5
    # margin: Z and D NULL (rank 1), A/B 60 % (rank 3), C 10 % (rank 5)
    assert got["D"]["margin_rank"] == 1
    assert got["A"]["margin_rank"] == got["B"]["margin_rank"] == 3
    assert got["C"]["margin_rank"] == 5
    a = got["A"]
    assert a["refund_count"] == 1 and a["total_refund_amount"] == 25.0
    assert a["refund_rate_of_revenue_pct"] == 25.0 and a["profit_margin_pct"] == 60.0


# ------------------------------------------------------------------ M3
def test_refund_trends_rows_frame_gap_and_rate_over_100(spark):
    products = [product(1, "A")]
    items = [
        item(1, "2014-01-10 00:00:00", 1, 1, 10, 5),
        item(2, "2014-02-10 00:00:00", 2, 1, 10, 5),
        item(3, "2014-06-10 00:00:00", 3, 1, 10, 5),  # gap: Mar-May without sales
        item(4, "2014-06-11 00:00:00", 4, 1, 10, 5),
    ]
    refunds = [
        refund(1, "2014-02-01 00:00:00", 1, 1, 10),  # January item refunded in February
        refund(2, "2014-02-02 00:00:00", 2, 2, 10),
        refund(3, "2014-04-01 00:00:00", 3, 3, 10),  # month without sales: dropped
    ]
    out = reports.refund_rate_trends(
        frame(spark, "order_items", items),
        frame(spark, "order_item_refunds", refunds),
        frame(spark, "products", products),
    )
    got = {str(r["refund_month"]): r.asDict() for r in out.collect()}
    assert set(got) == {"2014-01-01", "2014-02-01", "2014-06-01"}
    assert got["2014-02-01"]["refund_rate_pct"] == 200.0  # 2 refunds / 1 unit
    assert got["2014-01-01"]["refund_rate_pct"] == 0.0
    # the 3-row frame for June spans Jan..Jun: (0 + 200 + 0) / 3
    assert got["2014-06-01"]["rolling_3m_avg_refund_rate_pct"] == 66.67


# ------------------------------------------------------------------ M4
def test_median_even_and_odd_and_month_without_orders(spark):
    prices_jan = [10.0, 20.0, 30.0, 41.01]  # even: (20 + 30) / 2
    prices_feb = [5.0, 7.0, 100.0]  # odd
    orders = [order(i + 1, "2014-01-05 00:00:00", price=p) for i, p in enumerate(prices_jan)]
    orders += [order(i + 10, "2014-02-05 00:00:00", price=p, items=2) for i, p in enumerate(prices_feb)]
    sessions = [session(1, "2014-01-01 00:00:00"), session(2, "2014-03-01 00:00:00")]
    out = reports.order_value_trends(
        frame(spark, "orders", orders), frame(spark, "website_sessions", sessions)
    )
    got = {str(r["month"]): r.asDict() for r in out.collect()}
    assert set(got) == {"2014-01-01", "2014-02-01"}  # March has sessions only
    assert got["2014-01-01"]["median_order_value"] == statistics.median(prices_jan)
    assert got["2014-02-01"]["median_order_value"] == 7.0
    assert got["2014-02-01"]["sessions"] is None and got["2014-02-01"]["revenue_per_session"] is None
    assert got["2014-01-01"]["single_item_orders"] == 4 and got["2014-02-01"]["multi_item_orders"] == 3
    assert got["2014-02-01"]["pct_multi_item"] == 100.0


def test_median_half_cent_rounds_half_up(spark):
    orders = [order(1, "2014-01-05 00:00:00", price=10.01), order(2, "2014-01-06 00:00:00", price=10.02)]
    out = reports.order_value_trends_orders_only(frame(spark, "orders", orders))
    assert out.first()["median_order_value"] == 10.02  # 10.015 -> 10.02


def test_revenue_per_session_credits_session_month(spark):
    sessions = [session(1, "2014-01-31 23:00:00"), session(2, "2014-02-01 00:00:00")]
    orders = [
        order(1, "2014-02-01 01:00:00", sid=1, price=10.0),
        order(2, "2014-02-01 02:00:00", sid=1, price=5.0),  # second order, same session
    ]
    s, o = frame(spark, "website_sessions", sessions), frame(spark, "orders", orders)
    rps = {str(r["month"]): r.asDict() for r in reports.revenue_per_session(s, o).collect()}
    assert rps["2014-01-01"]["orders"] == 2 and rps["2014-01-01"]["revenue_per_session"] == 15.0
    assert rps["2014-02-01"]["orders"] == 0 and rps["2014-02-01"]["revenue_per_session"] is None
    ovt = {str(r["month"]): r.asDict() for r in reports.order_value_trends(o, s).collect()}
    assert list(ovt) == ["2014-02-01"] and ovt["2014-02-01"]["revenue_per_session"] == 15.0


# ------------------------------------------------------------------ M5
def test_cohort_year_boundary_late_months_null_user(spark):
    orders = [
        order(1, "2012-12-15 00:00:00", user=1),
        order(2, "2013-01-03 00:00:00", user=1),  # month 1 across the year boundary
        order(3, "2013-08-01 00:00:00", user=1),  # month 8: counted in no column
        order(4, "2013-01-20 00:00:00", user=2),
        order(5, "2013-01-21 00:00:00", user=2),  # same month twice: one customer
        order(6, "2013-01-22 00:00:00", user=None),  # excluded
    ]
    out = reports.cohort_retention(frame(spark, "orders", orders))
    got = {str(r["cohort_month"]): r.asDict() for r in out.collect()}
    assert set(got) == {"2012-12-01", "2013-01-01"}
    dec = got["2012-12-01"]
    assert dec["customers_in_cohort"] == 1 and dec["month_0"] == 1 and dec["month_1"] == 1
    assert dec["month_6"] == 0 and dec["retention_m1_pct"] == 100.0
    jan = got["2013-01-01"]
    assert jan["customers_in_cohort"] == jan["month_0"] == 1 and jan["month_1"] == 0
    long = reports.cohort_retention_long(frame(spark, "orders", orders)).collect()
    assert len(long) == 14 and all(r["customers_in_cohort"] >= r["active_customers"] for r in long)


# ------------------------------------------------------------------ M6, M7
def test_visitor_segments_null_flag_and_guest(spark):
    sessions = [
        session(1, "2014-01-01 00:00:00", user=1, repeat=0, device="mobile"),
        session(2, "2014-01-01 00:00:00", user=None, repeat=1),
        session(3, "2014-01-01 00:00:00", user=5, repeat=None),  # NULL flag
        session(4, "2014-01-01 00:00:00", user=6, repeat=1, device="mobile"),
    ]
    orders = [order(1, "2014-01-01 00:00:00", sid=3, price=9.99), order(2, "2014-01-01 00:00:00", sid=4, price=0.01)]
    out = reports.visitor_segments(
        frame(spark, "website_sessions", sessions), frame(spark, "orders", orders)
    )
    got = _rows(out, "customer_type")
    assert got["First-Time Visitor"]["sessions"] == 1 and got["First-Time Visitor"]["pct_mobile"] == 100.0
    assert got["Repeat Guest"]["sessions"] == 1 and got["Repeat Guest"]["avg_order_value"] is None
    reg = got["Repeat Registered"]
    assert reg["sessions"] == 2 and reg["orders"] == 2 and reg["avg_order_value"] == 5.0
    assert reg["total_revenue"] == 10.0 and reg["pct_mobile"] == 50.0


def test_conversion_for_period_half_open(spark):
    sessions = [
        session(1, "2012-04-01 00:00:00"),
        session(2, "2012-04-30 23:59:59"),
        session(3, "2012-05-01 00:00:00"),  # excluded
    ]
    orders = [order(1, "2012-04-01 00:00:00", sid=1), order(2, "2012-05-01 00:00:00", sid=3)]
    r = reports.conversion_for_period(
        frame(spark, "website_sessions", sessions), frame(spark, "orders", orders)
    ).first()
    assert (r["sessions"], r["orders"], r["conversion_rate"]) == (2, 1, 50.0)


def test_sql_over_registered_views(spark):
    from ledgerline.plans.marts import register_all
    from ledgerline.sources.testdata import shop_tables
    from tests.conftest import SF_SMALL

    t = shop_tables(spark, SF_SMALL)
    names = register_all(t.all(), since="1996-01-01")
    assert {"orders", "stg_orders", "mrt_channel_performance", "mrt_cohort_retention"} <= set(names)
    by_device = {r[0]: r[1] for r in spark.sql("SELECT device_type, count(*) FROM stg_website_sessions GROUP BY device_type").collect()}
    assert sum(by_device.values()) == t.website_sessions.count() and set(by_device) == {"mobile", "desktop"}
    assert spark.sql("SELECT count(*) AS n FROM mrt_channel_performance").first()["n"] > 0


def test_median_of_a_month_without_dates(spark):
    # orders with no created_at form their own (NULL) month, as GROUP BY does
    orders = [order(1, None, price=10.0), order(2, None, price=30.0), order(3, "2014-01-05 00:00:00", price=5.0)]
    got = {r["month"]: r["median_order_value"] for r in reports.order_value_trends_orders_only(frame(spark, "orders", orders)).collect()}
    assert got == {None: 20.0, __import__("datetime").date(2014, 1, 1): 5.0}
