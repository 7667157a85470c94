"""Loading (L1-L6, S5, S6): full refresh or watermark-incremental,
insert-if-absent, into Parquet targets.

A target is a Parquet folder holding the declared columns plus the two audit
columns. The incremental path reads one scalar back to the driver (the high
water mark, as a string so no time zone touches it; kept in a one-row state
file beside the data so no run scans the target for it), filters strictly
newer rows, drops rows whose key the target already holds (semi-join of the
keys of those files that may hold one (``key_ranges``) to the increment, then ``left_anti``: the ``ON CONFLICT DO
NOTHING`` of the reference) and appends. Re-running the same load therefore
appends nothing.

A load keeps one row per key of the batch itself (``unique_keys=True`` skips that
step for callers that did it), so keys stay unique whatever is handed in.

Writes go through Spark's file commit protocol: a failed or retried task
leaves no partial output, and the append becomes visible at job commit. A
full-refresh target is versioned: the new snapshot is written beside the old one and published by one
log entry, so a reader at any moment, and after a crash at any point, sees the old or the new rows in full.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import key_ranges
from ledgerline.operators.validate import keep_first
from ledgerline.schemas import (
    AUDIT_LOADED_AT,
    AUDIT_SOURCE,
    FULL_REFRESH,
    INCREMENTAL,
    TableSpec,
    spec_for,
    strategy_for,
)
from ledgerline.sources.files import (
    PARQUET_OPTIONS,
    current_snapshot,
    delete_path,
    holds_table,
    move_folder,
    path_exists,
    publish_snapshot,
    read_line,
    write_line,
    write_snapshot,
)


# ------------------------------------------------------------------ L1
def high_water_mark(target: DataFrame, column: str = "created_at") -> DataFrame:
    """One row: ``max(column)`` of the target (NULL when empty)."""
    return target.agg(F.max(column).alias("high_water_mark"))


def watermark_value(target: DataFrame | None, column: str = "created_at") -> str | None:
    """The high water mark as a wall-clock string (or None: first load).
    Collected as text and re-parsed as ``timestamp_ntz`` by the filter, so
    session and process time zones never shift it."""
    if target is None:
        return None
    row = target.agg(F.max(column).cast("string")).first()
    return row[0] if row else None


# The high water mark of a target, kept next to its data. Written after every
# committed append from metrics observed on that same append, so reading it
# costs one tiny file instead of a scan of ``created_at`` over the whole
# target. The folder starts with '_' and is therefore invisible to readers of
# the target. If it is missing (older targets) the scan is the fallback; if a
# write of it ever failed after a commit, the stale (lower) value only makes
# the next run re-read rows, which insert-if-absent then skips.
STATE_DIR = "_state/high_water_mark"
_NO_MARK = ""  # stored for a target whose rows all lack created_at


def _state_path(target_path: str) -> str:
    return f"{target_path.rstrip('/')}/{STATE_DIR}"


def stored_watermark(spark: SparkSession, target_path: str) -> tuple[bool, str | None]:
    """(found, value) of the high water mark kept with a target: one line of
    text read through the session's file system (no Spark job)."""
    line = read_line(spark, _state_path(target_path))
    return line is not None, line or None


def store_watermark(spark: SparkSession, target_path: str, value: str | None) -> None:
    """A reader sees the old or the new value, never a partial one and never none."""
    write_line(spark, _state_path(target_path), value or _NO_MARK)


def _mark_of(spark: SparkSession, target_path: str, target: DataFrame | None) -> tuple[bool, str | None]:
    if target is None:
        return True, None
    known, wm = stored_watermark(spark, target_path)
    return known, wm if known else watermark_value(target)  # no stored mark yet: one scan, then kept


def target_watermark(spark: SparkSession, target_path: str, spec: TableSpec | None) -> str | None:
    """The mark that the next load of this target filters by."""
    return _mark_of(spark, target_path, read_target(spark, target_path, spec))[1]


def _later(a: str | None, b: str | None) -> str | None:
    if a is None or b is None:
        return a if b is None else b
    return a if dt.datetime.fromisoformat(a) >= dt.datetime.fromisoformat(b) else b


# ------------------------------------------------------------------ L2
def filter_new_rows(
    df: DataFrame,
    watermark: str | None,
    column: str = "created_at",
    inclusive: bool = False,
    lateness: str | None = None,
) -> DataFrame:
    """Rows created after the watermark (strictly, by default). No watermark:
    every row, including NULL ``created_at`` ones; with a watermark NULL
    timestamps are dropped (``NULL > wm`` is not true). ``lateness`` (e.g.
    ``'2 days'``) lowers the bound to re-read late rows; combine it with the
    key anti-join so re-read rows are not duplicated."""
    if watermark is None:
        return df
    bound: Column = F.lit(watermark).cast("timestamp_ntz")
    if lateness:
        bound = bound - F.expr(f"INTERVAL {lateness}")
    return df.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)


def above_mark(watermark: str | None, column: str = "created_at") -> Column:
    """Whether a row is new, as ``filter_new_rows`` decides."""
    return F.lit(True) if watermark is None else F.coalesce(F.col(column) > F.lit(watermark).cast("timestamp_ntz"), F.lit(False))


# ------------------------------------------------------------------ L3
#: keys of an increment (8 bytes each) up to which they are broadcast to the target's scan
MAX_BROADCAST_KEYS = 2_000_000


def anti_existing(new_rows: DataFrame, target: DataFrame | None, pk: str) -> DataFrame:
    """Insert-if-absent: drop rows whose key exists in the target.

    One aggregation over the increment's key column gives its smallest and largest key
    and their number. The bounds go to the target scan as literals, so files and row groups
    without such keys are skipped; only the key column is read. Up to ``MAX_BROADCAST_KEYS`` keys are
    broadcast to that scan (the target is not shuffled), and the few keys found are broadcast
    back. Larger increments and the target's keys are sorted and merged by key, which is asked for: Spark estimates a
    key column by its small compressed file and would gather millions of keys in the driver to broadcast them.
    Hand in a stored increment: it is read twice."""
    if target is None:
        return new_rows
    incoming = new_rows.select(pk).filter(F.col(pk).isNotNull())
    low, high, n = incoming.agg(F.min(pk), F.max(pk), F.count(F.lit(1))).first()
    if not n:
        return new_rows
    held = target.select(pk).filter((F.col(pk) >= F.lit(low)) & (F.col(pk) <= F.lit(high)))
    if n > MAX_BROADCAST_KEYS:
        return new_rows.join(held.hint("merge"), pk, "left_anti")
    existing = held.join(F.broadcast(incoming), pk, "left_semi")
    return new_rows.join(F.broadcast(existing), pk, "left_anti")


# ------------------------------------------------------------------ L4
def align_columns(df: DataFrame, spec: TableSpec | None) -> DataFrame:
    """Project to the declared columns in declared order and types, then the
    audit columns; declared columns absent from the frame load as NULL, extra
    columns are dropped."""
    if spec is None:
        return df
    have = set(df.columns)
    cols = []
    for f in spec.full_schema.fields:
        if f.name in have:
            c = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                c = c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ L5
def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN -> NULL (the only way a NaN can reach a target)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ targets
def read_target(spark: SparkSession, path: str, spec: TableSpec | None) -> DataFrame | None:
    """The target's current rows, or None if there is none. File-system errors are raised: they never read as "no target"."""
    if not path_exists(spark, path):
        return None
    at = current_snapshot(spark, path)
    if at == path.rstrip("/") and not holds_table(spark, at):
        return None  # a first refresh has not been published yet
    reader = spark.read
    if spec is not None:
        reader = reader.schema(spec.full_schema)
    return reader.parquet(at)


def create_target(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """S7: an empty target of the declared columns, unless it is there; returns the target."""
    if read_target(spark, path, spec) is None:
        empty = spark.createDataFrame([], spec.full_schema)
        if strategy_for(spec.name) == FULL_REFRESH:
            publish_snapshot(spark, path, write_snapshot(empty, path))
        else:
            empty.write.mode("append").parquet(path)
    return read_target(spark, path, spec)


# ------------------------------------------------------------------ L6, S5, S6
@dataclass
class LoadResult:
    table: str
    strategy: str
    status: str
    rows_inserted: int
    watermark: str | None
    message: str = ""


def _count_observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def check_rows(table: str, staged: int, expected: int | None) -> None:
    if expected is not None and staged != expected:
        raise RuntimeError(f"{table}: {staged} rows staged of {expected}")


def one_row_per_key(df: DataFrame, pk: str) -> DataFrame:
    """One row of each key of a batch without a stated order: the smallest by its columns. NULL keys
    cannot be loaded and are dropped."""
    return keep_first(df, pk, [c for c in df.columns if c != pk], keep_null_keys=False)


def load_table(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    target_path: str,
    inclusive: bool = False,
    lateness: str | None = None,
    unique_keys: bool = False,
    watermark: tuple[str | None] | None = None,
    stored: bool = False,
    expected: int | None = None,
) -> LoadResult:
    """Strategy dispatch for one cleaned, validated frame (unknown tables are
    incremental). Returns how many rows were written.

    ``unique_keys``: the frame holds a key once. ``watermark``: a one-tuple with the mark to filter by
    instead of the stored one (a stream fixes it for a whole run). ``stored``: the frame is a scan
    of a stored table, cheap to read again. ``expected``: the number of rows of a full refresh or of a first load; it is
    checked before they become visible, and another number fails the load."""
    spec = spec_for(table)
    strategy = strategy_for(table)
    aligned = align_columns(nan_to_null(df), spec)
    if spec is not None and not unique_keys:
        aligned = one_row_per_key(aligned, spec.pk)

    if strategy == FULL_REFRESH:
        out, obs = _count_observed(aligned)
        snapshot = write_snapshot(out, target_path)
        try:
            check_rows(table, obs.get["rows"], expected)
        except RuntimeError:
            delete_path(spark, snapshot)
            raise
        publish_snapshot(spark, target_path, snapshot)
        return LoadResult(table, FULL_REFRESH, "loaded", int(obs.get["rows"]), None)

    target = read_target(spark, target_path, spec)
    known, wm = _mark_of(spark, target_path, target)
    new = filter_new_rows(aligned, wm if watermark is None else watermark[0], inclusive=inclusive, lateness=lateness)
    staged = None
    if spec is not None and target is not None and not target.isEmpty():  # a target without rows holds no key
        # the increment is read three times below: cut its lineage at a stored copy
        if not stored:
            staged = f"{target_path.rstrip('/')}.__increment-{uuid.uuid4().hex[:10]}"
            new.write.parquet(staged)
            new = spark.read.schema(new.schema).parquet(staged)
        new = anti_existing(new, key_ranges.may_hold(target, target_path, new, spec), spec.pk)
    obs = Observation()
    out = new.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.max("created_at").cast("string").alias("max_created_at"),
    )
    if spec is not None:
        # neighbours in time share row groups, so ranges of time (and of keys, which grow with it) prune them
        out = out.sortWithinPartitions(spec.watermark_column, spec.pk)
    # a checked first load is written beside its path, and one rename makes it the target
    first = f"{target_path.rstrip('/')}.__first-{uuid.uuid4().hex[:10]}" if expected is not None and not path_exists(spark, target_path) else None
    try:
        out.write.mode("append").options(**PARQUET_OPTIONS).parquet(first or target_path)
        if first:
            check_rows(table, obs.get["rows"], expected)
            move_folder(spark, first, target_path)
    finally:
        if first:
            delete_path(spark, first)
        if staged:
            delete_path(spark, staged)
    n = int(obs.get["rows"])
    new_wm = _later(wm, obs.get["max_created_at"]) if n else wm
    if n or not known:
        store_watermark(spark, target_path, new_wm)
    if n and spec is not None:
        key_ranges.add_new_files(spark, target_path, spec)
    return LoadResult(table, INCREMENTAL, "loaded" if n else "nothing new", n, wm)


def load_incremental_frame(
    new_rows: DataFrame, target: DataFrame | None, spec: TableSpec, inclusive: bool = False
) -> DataFrame:
    """The rows an incremental load would append, as a lazy frame
    (watermark filter + insert-if-absent), without writing."""
    wm = watermark_value(target)
    return anti_existing(filter_new_rows(new_rows, wm, inclusive=inclusive), target, spec.pk)


AUDIT_COLUMNS = (AUDIT_LOADED_AT, AUDIT_SOURCE)
