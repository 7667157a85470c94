"""Cleaning of generated messy CSV files against a row-by-row model of the rules (C1-C6, V4),
written from their definitions in plain Python."""

import csv
import datetime as dt
import os
import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import clean, validate
from ledgerline.sources.csv import read_csv

KEYS = st.sampled_from(["1", "2", "3", "4", "5", "", "NULL"])
TIMES = st.sampled_from(
    ["2012-03-19 08:04:16", "2012-03-19 08:04:17", "2013-01-01 00:00:00", "bad", "", "nan"]
)
MONEY = st.sampled_from(["49.99", "49.995", "1e3", "-0.005", "abc", "", "NaN", "10"])
TEXT = st.sampled_from(["a \"b\", c", "two\nlines", "back\\", "gsearch", " gsearch", "bsearch\t", "\tsocial book ", "NULL", "", "N/A"])
ROWS = st.lists(st.tuples(KEYS, TIMES, MONEY, TEXT), min_size=1, max_size=25)


MISSING = {"", "NULL", "nan", "NaN", "N/A"}


def model(rows) -> dict:
    """One pass in file order. A row seen before is an exact copy; a key seen before keeps its first row."""
    seen, kept = set(), {}
    for raw in rows:
        row = tuple(None if v in MISSING else v for v in raw)
        key, when, money, source = row
        if row in seen or key is None or int(key) in kept:
            continue
        seen.add(row)
        time = dt.datetime.strptime(when, "%Y-%m-%d %H:%M:%S") if when and re.fullmatch(r"[-0-9]+ [:0-9]+", when) else None
        number = Decimal(money).quantize(Decimal("0.01"), ROUND_HALF_UP) if money and re.fullmatch(r"-?[0-9.]+(e[0-9]+)?", money) else None
        kept[int(key)] = (time, number, source.strip() if source else source)
    return kept


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_clean_matches_the_rules(spark, tmp_dir, rows):
    path = os.path.join(tmp_dir, f"orders-{abs(hash(tuple(rows)))}.csv")
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["Order ID", " Created At ", "Price USD", "Utm Source"])
        w.writerows(rows)
    raw = read_csv(spark, path, with_order=True, multiline=True)
    cleaned = clean.clean_dataframe(raw, "orders", "2024-01-01 00:00:00", order_col="_file_order")
    kept = validate.keep_first(cleaned, "order_id", ["_file_order"], keep_null_keys=False)
    got = {
        r["order_id"]: (r["created_at"], r["price_usd"], r["utm_source"]) for r in kept.collect()
    }
    assert got == model(rows)
