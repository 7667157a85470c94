"""End-to-end load (L7) with its run summary (L8).

Per table: CSV scan -> clean -> validate -> load. The source is scanned once: cleaned rows are stored with their
hash, some marks and their place in the files, and both steps read that table, so a row has one identity however
the scan was split. Which rows are kept is decided on its narrow columns, in one exchange by key: exact copies collapse, then the
first row of each key in file order wins. The winners come back as bitmaps of positions, 4 KB for 32,768 positions, which are broadcast to the
stored rows: full rows are not shuffled (beyond ``MAX_BROADCAST_BITMAPS`` they join by bitmap number).
All failures are decided before a row is written. A first load and a full refresh then write the winners straight into the
target, which becomes visible when their number is checked; an increment is staged next to the targets, since its load reads it
several times. All counts of the summary are exact aggregates, stored with the bitmaps.

A table that fails (missing file, malformed row, no rows, bad key, write error) is reported
and does not stop the others.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.clean import (
    add_audit_columns,
    cast_declared,
    cast_numeric,
    cast_timestamps,
    normalize_columns,
    row_hashes,
    strip_text_columns,
)
from ledgerline.operators.load import above_mark, check_rows, load_table, read_target, target_watermark
from ledgerline.operators.validate import FAIL, KEEP_FIRST
from ledgerline.schemas import FULL_REFRESH, INCREMENTAL, NUMERIC_COLUMNS, TABLE_ORDER, TIMESTAMP_COLUMNS, spec_for, strategy_for
from ledgerline.sources import csv as csv_source
from ledgerline.sources.csv import CORRUPT, FILE_ORDER, csv_path, read_csv, with_file_position
from ledgerline.sources.files import PARQUET_OPTIONS, delete_path, path_exists

KEEP = "keep"
_COUNTS = (
    "malformed_rows",
    "rows_in",
    "exact_duplicates",
    "bad_dates",
    "bad_money",
    "null_keys",
    "bad_keys",
    "rows_clean",
    "duplicate_pks",
)
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("status", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)


@dataclass
class Counts:
    """What cleaning saw, in the order of the steps. ``rows_in`` leaves malformed rows out; bad dates and money
    (text that does not parse or fit, now NULL), NULL keys and unparseable keys (both dropped) are counted after
    exact copies are removed; ``rows_clean`` is what is left; ``duplicate_pks`` are its repeated keys."""

    malformed_rows: int = 0
    rows_in: int = 0
    exact_duplicates: int = 0
    bad_dates: int = 0
    bad_money: int = 0
    null_keys: int = 0
    bad_keys: int = 0
    rows_clean: int = 0
    duplicate_pks: int = 0


@dataclass
class TableRun:
    table_name: str
    strategy: str
    status: str
    counts: Counts | None = None
    rows_inserted: int | None = None
    watermark: str | None = None
    message: str = ""
    seconds: float | None = None

    def row(self) -> tuple:
        counts = astuple(self.counts) if self.counts else (None,) * len(_COUNTS)
        return (self.table_name, self.strategy, self.status, *counts, self.rows_inserted, self.watermark, self.message, self.seconds)


def _store_decoded(spark: SparkSession, raw: DataFrame, spec, path: str) -> tuple[DataFrame, list[str]]:
    """Write the cleaned rows of a scan once, with their hashes, flags and file position; returns that table and the
    names of its data columns. Whatever follows reads it: a second scan of the source may be cut into other splits
    (executors come and go), and then no row number of the first one means the same row."""
    pk = spec.pk if spec else None
    marks = [c for c in (FILE_ORDER, CORRUPT) if c in raw.columns]
    columns = normalize_columns(raw.drop(*marks)).columns
    if pk and pk not in columns:
        raise KeyError(f"primary key column {pk!r} missing")
    named = raw.select(*[F.col(f"`{a}`").alias(b) for a, b in zip(raw.drop(*marks).columns, columns)], *marks)
    if CORRUPT not in marks:
        named = named.withColumn(CORRUPT, F.lit(None).cast("string"))
    if FILE_ORDER not in marks:
        order = F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("pos"))
        named = named.withColumn(FILE_ORDER, order)

    before = [f"_raw_{c}" for c in columns]
    kept_raw = named.select("*", *[F.col(c).alias(b) for c, b in zip(columns, before)])
    typed = cast_declared(strip_text_columns(cast_numeric(cast_timestamps(kept_raw))), spec)
    lost = lambda c: F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull()
    dates = [c for c in TIMESTAMP_COLUMNS if c in columns]
    money = [c for c in NUMERIC_COLUMNS if c in columns]
    total = lambda cs: sum((lost(c).cast("int") for c in cs), F.lit(0))
    h1, h2 = row_hashes(before)
    marks = (
        (F.col(CORRUPT).isNotNull(), _MALFORMED),
        (F.col(pk).isNull() if pk else F.lit(False), _NO_KEY),
        (F.col(f"_raw_{pk}").isNull() if pk else F.lit(False), _NULL_KEY),
        (lost(pk) if pk else F.lit(False), _BAD_KEY),
    )
    flags = sum((c.cast("int") * bit for c, bit in marks), F.lit(0))
    decoded = typed.select(
        *columns,
        h1,
        # key and hash name a row; one without a key is named by two hashes
        (F.when(F.col(pk).isNull(), h2) if pk else h2).alias("_h2"),
        (flags + total(dates) * _DATES + total(money) * _MONEY).alias("_marks"),
        FILE_ORDER,
    )
    decoded.write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(path)
    return with_file_position(spark.read.schema(decoded.schema).parquet(path), "_at"), columns


#: ``_marks`` of a row: flags, then how many dates and money values were lost
_MALFORMED, _NO_KEY, _NULL_KEY, _BAD_KEY, _NEW, _DATES, _MONEY = 1, 2, 4, 8, 16, 1 << 8, 1 << 16
_SUMS = ("malformed", "rows_in", "rows", "dates", "money", "null_keys", "bad_keys", "clean", "keys", "new")
#: positions of one bitmap (as the bitmap functions fix it), and bitmaps of 4 KB up to which they are broadcast
_BITS = 32768
MAX_BROADCAST_BITMAPS = 25_000


def _decide(spark: SparkSession, stored: DataFrame, pk: str | None, watermark: str | None, path: str) -> tuple[dict[str, int], DataFrame]:
    """The counts of a stored scan, and its rows to load: of each key the first row in file order, if that is above
    ``watermark``. Narrow rows meet once, by key (rows without one by their hash); there exact copies collapse and the first
    row of the key is taken. Its position comes back as a bit of a bitmap, which is stored at ``path``
    next to the counts, so no full row moves to its key."""
    above = above_mark(watermark) if "created_at" in stored.columns else F.lit(watermark is None)
    flag = lambda bit: F.col("_marks").bitwiseAND(F.lit(bit)) != 0
    # what is alike in most rows comes first and what differs last, so shuffled rows compress well
    narrow = stored.select(
        "_h2",
        (F.col("_marks") + above.cast("int") * _NEW).alias("_marks"),
        (F.coalesce(F.col(pk).cast("long"), F.col("_h1")) if pk else F.col("_h1")).alias("_key"),
        "_h1",
        "_at",
    ).repartition("_key")
    # equal rows have equal marks
    rows = narrow.groupBy("_key", "_marks", "_h1", "_h2").agg(F.min("_at").alias("_at"), F.count(F.lit(1)).alias("_copies"))
    ok = ~flag(_MALFORMED)
    part = lambda shift: F.shiftright("_marks", shift).bitwiseAND(F.lit(255))
    one = lambda c: F.sum(c.cast("long"))
    keyed = ok & ~flag(_NO_KEY)
    # winners are told by an aggregate: a filter on group keys would move below the exchange, and then it is not shared
    keys = rows.groupBy("_key", "_h2", keyed.alias("_keyed")).agg(
        F.min("_at").alias("_at"),
        F.min_by(keyed & flag(_NEW), "_at").alias("_won"),
        one(F.when(ok, 0).otherwise(F.col("_copies"))).alias("malformed"),
        one(F.when(ok, F.col("_copies")).otherwise(0)).alias("rows_in"),
        one(ok).alias("rows"),
        one(F.when(ok, part(8)).otherwise(0)).alias("dates"),
        one(F.when(ok, part(16)).otherwise(0)).alias("money"),
        one(ok & flag(_NULL_KEY)).alias("null_keys"),
        one(ok & flag(_BAD_KEY)).alias("bad_keys"),
        one(ok & ~flag(_NO_KEY)).alias("clean"),
    )
    sums = keys.agg(*[F.sum(c).alias(c) for c in _SUMS[:-2]], F.count_if("_keyed").alias("keys"), F.count_if("_won").alias("new"))
    # positions move to their bitmap first: a task has few of each
    places = keys.filter("_won").select(F.shiftright("_at", 15).alias("_bitmap"), F.col("_at").bitwiseAND(F.lit(_BITS - 1)).alias("_bit"))
    bitmaps = places.repartition("_bitmap").groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    decided = bitmaps.unionByName(sums, allowMissingColumns=True)
    decided.write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(path)
    found = spark.read.schema(decided.schema).parquet(path)
    counts = {c: int(v or 0) for c, v in found.filter(F.col("_bitmap").isNull()).select(*_SUMS).first().asDict().items()}
    bitmaps = found.filter(F.col("_bitmap").isNotNull()).select("_bitmap", "_bits")
    few = bitmaps.limit(MAX_BROADCAST_BITMAPS + 1).count() <= MAX_BROADCAST_BITMAPS
    place = F.col("_at").bitwiseAND(F.lit(_BITS - 1)).cast("int")
    byte = F.ascii(F.decode(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1)), "ISO-8859-1"))
    won = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), place.bitwiseAND(F.lit(7)))) != 0
    full = stored.withColumn("_bitmap", F.shiftright("_at", 15)).join(F.broadcast(bitmaps) if few else bitmaps, "_bitmap")
    return counts, full.filter(won)


@contextmanager
def clean_rows(
    spark: SparkSession, raw: DataFrame, table: str, scratch: str, run_ts: str, watermark: str | None = None
) -> Iterator[tuple[Counts, int, DataFrame]]:
    """The counts of ``raw`` (with its file order) cleaned, the number of rows to load, and these rows: the first row
    per key, if above ``watermark`` (all without one). They are read from tables that stay as long as the context."""
    spec = spec_for(table)
    decoded_path, decided_path = f"{scratch}.__decoded", f"{scratch}.__decided"
    try:
        stored, columns = _store_decoded(spark, raw, spec, decoded_path)
        n, full = _decide(spark, stored, spec.pk if spec else None, watermark, decided_path)
        full = add_audit_columns(full.select(*columns), table, run_ts)
        counts = Counts(
            n["malformed"],
            n["rows_in"],
            n["rows_in"] - n["rows"],
            n["dates"],
            n["money"],
            n["null_keys"],
            n["bad_keys"],
            n["clean"],
            n["clean"] - n["keys"],
        )
        yield counts, n["new"], full
    finally:
        delete_path(spark, decided_path)
        delete_path(spark, decoded_path)


def stage_clean_table(
    spark: SparkSession,
    raw: DataFrame,
    table: str,
    staging_path: str,
    run_ts: str,
    watermark: str | None = None,
) -> Counts:
    """Write the rows of ``clean_rows`` to ``staging_path``; returns the counts. Fails if it staged another number of
    rows than it decided on."""
    with clean_rows(spark, raw, table, staging_path, run_ts, watermark) as (counts, new, full):
        _stage(full, table, new, staging_path)
    return counts


def _stage(full: DataFrame, table: str, new: int, path: str) -> None:
    staged = Observation()
    full.observe(staged, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(**PARQUET_OPTIONS).parquet(path)
    check_rows(table, staged.get["n"], new)


@dataclass(frozen=True)
class Options:
    """Load options of one run. ``malformed``: rows with surplus fields ``fail`` the table or ``count`` (and stay
    out). ``on_bad_value``: with ``fail``, unparseable keys and money that does not fit fail the table;
    with ``keep`` they are dropped / NULL, and counted. ``multiline``: quoted fields may span lines."""

    on_duplicate: str = KEEP_FIRST
    malformed: str = csv_source.FAIL
    on_bad_value: str = KEEP
    multiline: bool = False


def _run_table(spark: SparkSession, table: str, source_dir: str, target_dir: str, run_ts: str, options: Options) -> TableRun:
    """Extract -> clean -> validate -> load for one table, timed; never
    raises."""
    t0 = time.perf_counter()
    run = _load_one(spark, table, source_dir, target_dir, run_ts, options)
    run.seconds = round(time.perf_counter() - t0, 3)
    return run


def _load_one(spark: SparkSession, table: str, source_dir: str, target_dir: str, run_ts: str, options: Options) -> TableRun:
    strategy = strategy_for(table)
    path = csv_path(source_dir, table)
    target_path = f"{target_dir}/{table}"
    staging = f"{target_dir}/_staging/{table}-{uuid.uuid4().hex[:10]}"
    failed = lambda message, counts=None: TableRun(table, strategy, "failed", counts, message=message)
    try:
        if not path_exists(spark, path):
            return failed("file not found")
        spec = spec_for(table)
        mark = target_watermark(spark, target_path, spec) if strategy == INCREMENTAL else None
        raw = read_csv(spark, path, with_order=True, multiline=options.multiline, malformed=options.malformed)
        with clean_rows(spark, raw, table, staging, run_ts, mark) as (counts, new, rows):
            if counts.rows_clean == 0:
                return failed("no rows", counts)
            if options.on_duplicate == FAIL and counts.duplicate_pks:
                return failed("duplicate keys", counts)
            if options.on_bad_value == FAIL and (counts.bad_keys or counts.bad_money):
                return failed(f"{counts.bad_keys} bad keys, {counts.bad_money} bad money values", counts)
            if strategy == FULL_REFRESH or not path_exists(spark, target_path):
                res = load_table(spark, rows, table, target_path, unique_keys=True, expected=new)
            else:  # an increment is read several times
                _stage(rows, table, new, staging)
                res = load_table(spark, spark.read.parquet(staging), table, target_path, unique_keys=True, stored=True)
        return TableRun(table, res.strategy, res.status, counts, res.rows_inserted, res.watermark)
    except Exception as exc:  # one table's failure does not stop the rest
        return failed(f"{type(exc).__name__}: {exc}")
    finally:
        try:
            delete_path(spark, staging)
        except Exception:  # pragma: no cover - best effort cleanup
            pass


def run_pipeline(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    tables=TABLE_ORDER,
    run_ts: str | None = None,
    on_duplicate: str = KEEP_FIRST,
    parallel_tables: int = 3,
    malformed: str = csv_source.FAIL,
    on_bad_value: str = KEEP,
    multiline: bool = False,
) -> DataFrame:
    """Load every table of ``tables`` from ``source_dir/<table>.csv`` into
    ``target_dir/<table>``; returns the run summary as a DataFrame (in
    ``tables`` order). The options are those of ``Options``.

    Tables are independent, so up to ``parallel_tables`` of them run as
    concurrent Spark jobs (submitted from driver threads; the scheduler
    shares the executors), which keeps a cluster busy while small tables
    load next to large ones."""
    run_ts = run_ts or time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())
    target_dir = target_dir.rstrip("/")
    tables = list(tables)
    options = Options(on_duplicate, malformed, on_bad_value, multiline)
    workers = max(1, min(parallel_tables, len(tables)))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        runs = list(
            pool.map(
                lambda t: _run_table(spark, t, source_dir, target_dir, run_ts, options),
                tables,
            )
        )
    return spark.createDataFrame([r.row() for r in runs], SUMMARY_SCHEMA)


def read_loaded(spark: SparkSession, target_dir: str, tables=TABLE_ORDER) -> dict[str, DataFrame]:
    """The loaded targets as DataFrames (tables that exist)."""
    found = {t: read_target(spark, f"{target_dir.rstrip('/')}/{t}", spec_for(t)) for t in tables}
    return {t: df for t, df in found.items() if df is not None}
