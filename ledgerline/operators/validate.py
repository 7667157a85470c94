"""Validation (V1-V5) and keep-first de-duplication of primary keys.

``validation_report`` computes every check of one table in a single
aggregation pass and returns it as a one-row DataFrame; ``validate`` collects
that one row and decides pass / fail on the driver (the only value that
crosses to the driver is the row of counts).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import spec_for

KEEP_FIRST = "keep_first"
FAIL = "fail"


def first_positions(df: DataFrame, pk: str, position: str, *carry: str) -> DataFrame:
    """Key, smallest ``position`` (a number unique to each row) and the ``carry`` columns of that row, of every non-NULL key. All
    buffers have a fixed width, so this is a hash aggregate on both sides of the exchange and moves no other column."""
    return (
        df.filter(F.col(pk).isNotNull())
        .groupBy(pk)
        .agg(F.min(position).alias("_first"), *[F.min_by(c, position).alias(c) for c in carry])
        .withColumnRenamed("_first", position)
    )


def keep_first_at(df: DataFrame, pk: str, position: str) -> DataFrame:
    """V4 by a stored ``position``: the rows that come first among those of their key. Keys and positions alone are
    aggregated; the rows meet the winning positions in a semi-join. Hand in a stored frame: it is read twice."""
    return df.join(first_positions(df.select(pk, position), pk, position).select(position), position, "left_semi").select(*df.columns)


def keep_first(
    df: DataFrame, pk: str, order_by: Sequence[str | Column], keep_null_keys: bool = True
) -> DataFrame:
    """V4: one row per ``pk``, the first by ``order_by`` (the caller's
    tie-break: a file-order key, or business columns).

    Implemented as ``min_by(row, order)`` per key: a partial aggregate, so a
    key repeated millions of times is reduced on the map side to one
    candidate per task before the shuffle (no hot task). Spark runs it as a sort aggregate on both sides of
    the exchange; where only few rows are wanted, decide on narrow rows first, as ``plans.pipeline`` does.
    Rows with a NULL key are kept as they are (the NULL-key rule is separate).
    """
    cols = df.columns
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    picked = (
        df.filter(F.col(pk).isNotNull())
        .groupBy(pk)
        .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row"))
        .select("_row.*")
    )
    if not keep_null_keys:
        return picked
    return picked.unionByName(df.filter(F.col(pk).isNull()))


def validation_report(df: DataFrame, table: str) -> DataFrame:
    """V1, V2, V3, V5 for one table as one row: rows, whether the key column
    exists, NULL keys, duplicate keys (rows - distinct non-NULL keys - NULL
    keys), and the pass flag (non-empty, key present, no NULL key)."""
    spec = spec_for(table)
    pk = spec.pk if spec else None
    has_pk = bool(pk and pk in df.columns)
    if has_pk:
        per_key = df.groupBy(pk).agg(F.count(F.lit(1)).alias("_n"))
        agg = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(F.col(pk).isNull(), F.col("_n"))), F.lit(0)).alias(
                "null_pk_count"
            ),
            F.coalesce(
                F.sum(F.when(F.col(pk).isNotNull(), F.col("_n") - 1)), F.lit(0)
            ).alias("duplicate_pk_count"),
        )
    else:
        agg = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            "row_count",
            F.lit(0).cast("bigint").alias("null_pk_count"),
            F.lit(0).cast("bigint").alias("duplicate_pk_count"),
        )
    passed = (F.col("row_count") > 0) & F.lit(has_pk or pk is None) & (F.col("null_pk_count") == 0)
    return agg.select(
        F.lit(table).alias("table_name"),
        F.lit(pk).cast("string").alias("pk_column"),
        F.lit(has_pk).alias("pk_present"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("null_pk_count").cast("bigint").alias("null_pk_count"),
        F.col("duplicate_pk_count").cast("bigint").alias("duplicate_pk_count"),
        passed.alias("passed"),
    )


@dataclass
class Validation:
    passed: bool
    rows: int
    null_pks: int
    duplicate_pks: int
    frame: DataFrame
    message: str = ""


def validate(
    df: DataFrame,
    table: str,
    on_duplicate: str = KEEP_FIRST,
    order_by: Sequence[str | Column] | None = None,
) -> Validation:
    """Run the checks; on duplicate keys either keep the first row per key
    (default, as the reference does) or fail. Returns the frame to load."""
    spec = spec_for(table)
    r = validation_report(df, table).first()
    rows, nulls, dups = int(r["row_count"]), int(r["null_pk_count"]), int(r["duplicate_pk_count"])
    if rows == 0:
        return Validation(False, rows, nulls, dups, df, "no rows")
    if spec and not r["pk_present"]:
        return Validation(False, rows, nulls, dups, df, f"primary key {spec.pk!r} missing")
    if nulls:
        return Validation(False, rows, nulls, dups, df, f"{nulls} NULL primary keys")
    out = df
    if dups and spec:
        if on_duplicate == FAIL:
            return Validation(False, rows, nulls, dups, df, f"{dups} duplicate primary keys")
        tiebreak = list(order_by) if order_by else [c for c in df.columns if c != spec.pk]
        out = keep_first(df, spec.pk, tiebreak)
    return Validation(True, rows, nulls, dups, out, "ok")
