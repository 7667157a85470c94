"""Small hand-written frames in the declared schemas."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from ledgerline.schemas import TABLES


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def money(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def frame(spark, table: str, rows: list[dict]):
    """Rows given as dicts (missing columns NULL) in the table's schema."""
    schema = TABLES[table].schema
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def session(sid, created, user=None, repeat=0, source=None, campaign=None, device="desktop"):
    return dict(
        website_session_id=sid,
        created_at=ts(created),
        user_id=user,
        is_repeat_session=repeat,
        utm_source=source,
        utm_campaign=campaign,
        device_type=device,
    )


def order(oid, created, sid=None, user=None, price=10.0, items=1, product=1, cogs=None):
    return dict(
        order_id=oid,
        created_at=ts(created) if created else None,
        website_session_id=sid,
        user_id=user,
        primary_product_id=product,
        items_purchased=items,
        price_usd=money(price),
        cogs_usd=money(cogs),
    )


def item(iid, created, oid, product, price, cogs):
    return dict(
        order_item_id=iid,
        created_at=ts(created),
        order_id=oid,
        product_id=product,
        is_primary_item=1,
        price_usd=money(price),
        cogs_usd=money(cogs),
    )


def refund(rid, created, iid, oid, amount):
    return dict(
        order_item_refund_id=rid,
        created_at=ts(created),
        order_item_id=iid,
        order_id=oid,
        refund_amount_usd=money(amount),
    )


def product(pid, name):
    return dict(product_id=pid, created_at=None, product_name=name)
