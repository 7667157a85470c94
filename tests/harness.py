"""Spark-vs-DuckDB comparison, the same shape as the driver's correctness gate:
row count, column names, and an order-insensitive comparison of values.

Run as a script to check every registered query:

    python tests/harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def _spark_kind(dt) -> str:
    n = dt.typeName()
    if n in ("byte", "short", "integer", "long"):
        return f"int:{n}"
    if n in ("float", "double"):
        return "double"
    if n.startswith("decimal"):
        return "decimal"
    return {"timestamp_ntz": "timestamp", "timestamp": "timestamp"}.get(n, n)


def _duck_kind(t: str) -> str:
    t = t.upper()
    ints = {"TINYINT": "byte", "SMALLINT": "short", "INTEGER": "integer", "BIGINT": "long"}
    if t in ints:
        return f"int:{ints[t]}"
    if t in ("HUGEINT", "UBIGINT", "UINTEGER"):
        return f"int:{t.lower()}"
    if t in ("DOUBLE", "FLOAT"):
        return "double"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}.get(t, t.lower())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    rows = [tuple(r) for r in df.collect()]
    return list(df.columns), rows


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    return list(rel.columns), rel.fetchall()


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[key](spark, sf_dir)
    s_types = {f.name: _spark_kind(f.dataType) for f in sdf.schema.fields}
    s_cols, s_rows = spark_rows(sdf)
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = E.oracle_sql().get(key)
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.sql(sql)
    d_types = {c: _duck_kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    d_cols, d_rows = list(rel.columns), rel.fetchall()
    type_diff = {c: (s_types.get(c), d_types.get(c)) for c in d_types if s_types.get(c) != d_types.get(c)}
    res["types_match"] = not type_diff
    if type_diff:
        res["type_diff"] = type_diff
    res["oracle_rows"] = len(d_rows)
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    res["columns_match"] = sc == dc
    res["values_match"] = sr == dr
    if sc != dc:
        res["spark_columns"] = sc
        res["oracle_columns"] = dc
    elif sr != dr:
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["spark_only"] = diff_s
        res["oracle_only"] = diff_d
    res["ok"] = bool(sc == dc and sr == dr and not type_diff)
    return res


def main(argv: list[str]) -> int:
    from ledgerline.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E

    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for key in keys or list(E.queries()):
        try:
            r = compare(spark, key, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": key, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("ok", r.get("oracle") == "none")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} failing", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
