"""Cleaning (C1-C8): raw string frame -> typed frame with audit columns.

The steps run in the reference's order: header normalisation, exact-row
de-duplication (before any cast, NULL equal to NULL), timestamp and money
casts (unparseable -> NULL), whitespace strip on text columns, drop NULL
primary keys, audit columns. All are column expressions plus one aggregation
(the de-duplication), so cleaning is a single shuffle whatever the size.
"""

from __future__ import annotations

import sys
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import (
    AUDIT_LOADED_AT,
    AUDIT_SOURCE,
    NUMERIC_COLUMNS,
    TEXT_COLUMNS,
    TIMESTAMP_COLUMNS,
    TableSpec,
    spec_for,
)

# Python's str.strip() removes every character for which str.isspace() is
# true; the set is generated from that rule rather than listed by hand.
_PY_WHITESPACE = "".join(
    ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace()
)

# Extra wall-clock formats accepted after ISO 8601 (spreadsheet exports): M/d/yyyy, with
# H:mm or H:mm:ss after a space. Each is rewritten as ISO text and cast as such.
SPREADSHEET_FORMS = (
    (r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{2}:\d{2})$", "$3-$1-$2 $4"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{2})$", "$3-$1-$2 $4:00"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
)


def normalize_header(name: str) -> str:
    return name.lower().strip().replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """C1: lower-case, strip, spaces to underscores. Two headers that end up
    equal raise instead of silently shadowing each other."""
    new = [normalize_header(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"headers {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def drop_duplicate_rows(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """C2: drop rows equal in every column (NULL equals NULL). With a
    file-order column the surviving copy keeps the first position."""
    if order_col is None:
        return df.dropDuplicates()
    cols = [c for c in df.columns if c != order_col]
    return df.groupBy(*cols).agg(F.min(order_col).alias(order_col))


def parse_timestamp(c: Column) -> Column:
    """Text -> ``timestamp_ntz``; NULL when nothing parses. No step passes through a zoned timestamp, so
    wall-clock times that a session zone skips or repeats stay as they are."""
    s = c.cast("string")
    # the spreadsheet forms have slashes, which no ISO time has: other text meets no regular expression
    sheet = F.coalesce(*[F.regexp_replace(s, form, iso).try_cast("timestamp_ntz") for form, iso in SPREADSHEET_FORMS])
    return F.when(s.contains("/"), F.coalesce(s.try_cast("timestamp_ntz"), sheet)).otherwise(s.try_cast("timestamp_ntz"))


def cast_timestamps(df: DataFrame, columns=TIMESTAMP_COLUMNS) -> DataFrame:
    """C3."""
    return df.select(
        *[parse_timestamp(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def cast_numeric(
    df: DataFrame, columns=NUMERIC_COLUMNS, dtype: T.DataType = T.DecimalType(10, 2)
) -> DataFrame:
    """C4: to the declared money type; unparseable or out-of-range -> NULL."""
    return df.select(
        *[F.col(c).try_cast(dtype).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def strip_text(c: Column) -> Column:
    """Strip leading/trailing whitespace as Python's ``str.strip`` does
    (tabs, NBSP, …); a whitespace-only value becomes ''. ``btrim`` with a
    character set (not ``trim``, which only removes spaces) stays in codegen
    and is about twice as fast as an anchored regex."""
    return F.btrim(c, F.lit(_PY_WHITESPACE))


def strip_text_columns(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    """C5."""
    return df.select(
        *[
            strip_text(F.col(c)).alias(c)
            if c in columns and isinstance(df.schema[c].dataType, T.StringType)
            else F.col(c)
            for c in df.columns
        ]
    )


def drop_null_pk(df: DataFrame, pk: str | None) -> DataFrame:
    """C6."""
    if pk and pk in df.columns:
        return df.filter(F.col(pk).isNotNull())
    return df


def add_audit_columns(df: DataFrame, table: str, run_ts: str) -> DataFrame:
    """C7: one load time per table per run (a parameter, so runs are
    reproducible) and the source table name."""
    return df.withColumn(AUDIT_LOADED_AT, F.lit(run_ts).cast("timestamp_ntz")).withColumn(
        AUDIT_SOURCE, F.lit(table)
    )


def cast_declared(df: DataFrame, spec: TableSpec | None) -> DataFrame:
    """Cast every declared column present to its declared type (``try_cast``),
    so the primary key is typed before the NULL-key rule runs."""
    if spec is None:
        return df
    types = {f.name: f.dataType for f in spec.schema.fields}
    return df.select(
        *[
            F.col(c).try_cast(types[c]).alias(c)
            if c in types and df.schema[c].dataType != types[c]
            else F.col(c)
            for c in df.columns
        ]
    )


def clean_dataframe(
    df: DataFrame,
    table: str,
    run_ts: str,
    order_col: str | None = None,
    drop_exact_duplicates: bool = True,
) -> DataFrame:
    """C1 -> C7 for one raw table (``order_col``: optional file-order key,
    carried through for keep-first de-duplication of keys).

    ``drop_exact_duplicates=False`` skips C2 for callers that keep the first
    row per primary key anyway: identical rows share their key, so keep-first
    removes them too and yields the same rows, and one full shuffle of every
    column is saved."""
    spec = spec_for(table)
    out = normalize_columns(df)
    if drop_exact_duplicates:
        out = drop_duplicate_rows(out, order_col)
    out = cast_timestamps(out)
    out = cast_numeric(out)
    out = strip_text_columns(out)
    out = cast_declared(out, spec)
    out = drop_null_pk(out, spec.pk if spec else None)
    return add_audit_columns(out, table, run_ts)


def row_hashes(columns) -> list[Column]:
    """Two 64-bit hashes of a raw row; NULL and its position count."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
    return [F.xxhash64(*cells).alias("_h1"), F.xxhash64(F.lit(1), *cells).alias("_h2")]


def account(df: DataFrame, table: str) -> DataFrame:
    """All counts of cleaning and validating a raw frame (C8, V1, V3, V5) as one row.

    Rows are reduced to their typed key, two row hashes and a flag before anything moves: one exchange collapses
    exact copies, a second one (a row per distinct row, collapsed again before it) counts keys. Full rows are never shuffled, and
    neither copies of one row nor rows of one key meet in one task before they are aggregated."""
    spec = spec_for(table)
    norm = normalize_columns(df)
    cols = norm.columns
    pk = spec.pk if spec and spec.pk in cols else None
    when = parse_timestamp(F.col("created_at")).isNull() if "created_at" in cols else F.lit(False)
    key = F.col(pk).try_cast(spec.schema[pk].dataType) if pk else F.lit(None).cast("long")
    narrow = norm.select(key.alias("_pk"), *row_hashes(cols), when.cast("int").alias("_bad"))
    rows = narrow.groupBy("_pk", "_h1", "_h2").agg(F.count(F.lit(1)).alias("_copies"), F.max("_bad").alias("_bad"))
    keys = rows.groupBy("_pk").agg(F.sum("_copies").alias("_in"), F.count(F.lit(1)).alias("_rows"), F.sum("_bad").alias("_bad"))
    no_key = F.col("_pk").isNull() if pk else F.lit(False)
    known = F.col("_pk").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return keys.agg(
        F.sum("_in").alias("rows_in"),
        (F.sum("_in") - F.sum("_rows")).alias("duplicates_removed"),
        total("_bad").alias("unparseable_dates"),
        total(F.when(no_key, F.col("_rows"))).alias("null_pk_dropped"),
        total(F.when(~no_key, F.col("_rows"))).alias("rows_out"),
        total(F.when(known, F.col("_rows") - 1)).alias("duplicate_pk_count"),
    )


def clean_report(df: DataFrame, table: str) -> DataFrame:
    """C8: one row of cleaning metrics."""
    counts = account(df, table).drop("duplicate_pk_count")
    return counts.select(F.lit(table).alias("table_name"), *counts.columns)


def raw_validation_report(df: DataFrame, table: str) -> DataFrame:
    """``validate.validation_report`` of the cleaned rows of a raw frame, without building them: the same counts of the same
    pass as ``clean_report``."""
    spec = spec_for(table)
    pk = spec.pk if spec else None
    present = bool(pk and pk in normalize_columns(df).columns)
    n = account(df, table)
    return n.select(
        F.lit(table).alias("table_name"),
        F.lit(pk).cast("string").alias("pk_column"),
        F.lit(present).alias("pk_present"),
        F.col("rows_out").alias("row_count"),
        F.lit(0).cast("bigint").alias("null_pk_count"),
        F.col("duplicate_pk_count"),
        ((F.col("rows_out") > 0) & F.lit(present or pk is None)).alias("passed"),
    )
