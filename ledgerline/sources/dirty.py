"""Raw, messy text tables derived from the clean test tables.

The parquet test data is clean, so the cleaning / validation / load
operators are exercised on a deterministic corruption of it, derived in the
same plan (every row of the source is kept; dirt is added by key rules):

* every column becomes text, headers become ``" Title Case "`` words;
* key NULL where ``key % 50 = 0``;
* ``created_at`` = ``'bad'`` where ``key % 37 = 0``;
* money = ``'abc'`` where ``key % 41 = 0``, ``'1e3'`` where ``key % 43 = 0``;
* text padded with tab / space / no-break space where ``key % 5 = 0``;
* exact duplicate of the row where ``key % 7 = 0``;
* near duplicate (same key, ``created_at`` replaced) where ``key % 11 = 0``,
  appended after the originals so "first in file order" is the original.

The same rules are rendered as DuckDB SQL (``dirty_sql``) for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import NUMERIC_COLUMNS, TEXT_COLUMNS, spec_for

# Fixed values of the corruption rules.
NULL_KEY_MOD = 50
BAD_DATE_MOD = 37
BAD_MONEY_MOD = 41
SCI_MONEY_MOD = 43
PAD_TEXT_MOD = 5
EXACT_DUP_MOD = 7
NEAR_DUP_MOD = 11
NEAR_DUP_CREATED_AT = "2001-12-31 00:00:00"
PAD_LEFT = "\t "
PAD_RIGHT = "  "


def messy_header(name: str) -> str:
    return " " + name.replace("_", " ").title() + " "


def _dirty_columns(table: str) -> list[tuple[str, Column]]:
    spec = spec_for(table)
    k = F.col(spec.pk)
    out = []
    for f in spec.schema.fields:
        c = F.col(f.name).cast("string")
        if f.name == spec.pk:
            c = F.when(k % NULL_KEY_MOD == 0, F.lit(None).cast("string")).otherwise(c)
        elif f.name == "created_at":
            c = F.when(k % BAD_DATE_MOD == 0, F.lit("bad")).otherwise(c)
        elif f.name in NUMERIC_COLUMNS:
            c = (
                F.when(k % BAD_MONEY_MOD == 0, F.lit("abc"))
                .when(k % SCI_MONEY_MOD == 0, F.lit("1e3"))
                .otherwise(c)
            )
        elif f.name in TEXT_COLUMNS:
            c = F.when(
                (k % PAD_TEXT_MOD == 0) & c.isNotNull(),
                F.concat(F.lit(PAD_LEFT), c, F.lit(PAD_RIGHT)),
            ).otherwise(c)
        out.append((f.name, c))
    return out


def dirty_raw(df: DataFrame, table: str, messy_headers: bool = True) -> DataFrame:
    """All-text raw frame with the corruption rules applied (see module doc).

    One pass over the source: each row explodes into its copies (0 the
    original, 1 an exact copy, 2 a near copy) in that order, so every copy
    sits right after its original in the same partition."""
    spec = spec_for(table)
    k = F.col(spec.pk)
    copies = F.filter(
        F.array(F.lit(0), F.lit(1), F.lit(2)),
        lambda i: (i == 0)
        | ((i == 1) & (k % EXACT_DUP_MOD == 0))
        | ((i == 2) & (k % NEAR_DUP_MOD == 0)),
    )
    seq = F.col("_dirt_seq")
    exploded = df.select("*", F.explode(copies).alias("_dirt_seq"))
    cols = []
    for n, c in _dirty_columns(table):
        if n == "created_at":
            c = F.when(seq == 2, F.lit(NEAR_DUP_CREATED_AT)).otherwise(c)
        cols.append(c.alias(n))
    out = exploded.select(*cols)
    if messy_headers:
        out = out.toDF(*[messy_header(c) for c in out.columns])
    return out


# ---------------------------------------------------------------- SQL twin
def _sql_columns(table: str, near: bool = False) -> list[str]:
    spec = spec_for(table)
    k = spec.pk
    exprs = []
    for f in spec.schema.fields:
        n = f.name
        if n == k:
            e = f"CASE WHEN {k} % {NULL_KEY_MOD} = 0 THEN NULL ELSE CAST({k} AS VARCHAR) END"
        elif n == "created_at":
            if near:
                e = f"'{NEAR_DUP_CREATED_AT}'"
            else:
                e = f"CASE WHEN {k} % {BAD_DATE_MOD} = 0 THEN 'bad' ELSE CAST(created_at AS VARCHAR) END"
        elif n in NUMERIC_COLUMNS:
            e = (
                f"CASE WHEN {k} % {BAD_MONEY_MOD} = 0 THEN 'abc' "
                f"WHEN {k} % {SCI_MONEY_MOD} = 0 THEN '1e3' ELSE CAST({n} AS VARCHAR) END"
            )
        elif n in TEXT_COLUMNS:
            e = (
                f"CASE WHEN {k} % {PAD_TEXT_MOD} = 0 AND {n} IS NOT NULL "
                f"THEN chr(9) || ' ' || {n} || ' ' || chr(160) ELSE {n} END"
            )
        else:
            e = f"CAST({n} AS VARCHAR)"
        exprs.append(f"{e} AS {n}")
    return exprs


def dirty_sql(table: str, source: str | None = None) -> str:
    """DuckDB SELECT producing the same rows as ``dirty_raw`` (clean headers)
    plus ``_dirt_seq`` (0 original, 1 exact copy, 2 near copy)."""
    spec = spec_for(table)
    src = source or table
    k = spec.pk
    base = ", ".join(_sql_columns(table))
    near = ", ".join(_sql_columns(table, near=True))
    return (
        f"SELECT {base}, 0 AS _dirt_seq FROM {src}\n"
        f"UNION ALL SELECT {base}, 1 AS _dirt_seq FROM {src} WHERE {k} % {EXACT_DUP_MOD} = 0\n"
        f"UNION ALL SELECT {near}, 2 AS _dirt_seq FROM {src} WHERE {k} % {NEAR_DUP_MOD} = 0"
    )


def strip_sql(expr: str) -> str:
    """DuckDB strip of the padding characters used by the rules."""
    return f"trim({expr}, chr(9) || ' ' || chr(160))"
