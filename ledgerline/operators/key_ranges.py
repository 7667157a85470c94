"""Which files of an appended target may hold which keys (L3).

Beside the target lies a table of key ranges: for every file and every band of ``BAND`` consecutive keys that it
has, the smallest and the largest key of the band in that file. A file of a stretch of keys is a row per band, so the table is a small
part of the key column; it never has more rows than the target has keys. An increment is reduced to ranges by band, too, and a join by
band names the files it may meet. Only those are opened for their keys, however the increment's keys are spread.

The table is written after each append, a folder an append, and folders count once a line of a log names them; above
``MAX_PARTS`` they are merged into one. Files that no counted folder lists (a writer was killed in between, or the
target is older than the table) are always opened: the table only ever leaves out files that it knows. A target has one writer.

Only the names of files reach the driver, which holds them for every scan of the target anyway.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import TableSpec
from ledgerline.sources.files import PARQUET_OPTIONS, delete_path, read_line, write_line

#: keys of a band, as a power of two
BAND_BITS = 14
#: folders of ranges before they are merged
MAX_PARTS = 16
SCHEMA = "file string, band long, low long, high long"


def _folder(target_path: str) -> str:
    return f"{target_path.rstrip('/')}/_state/key_ranges"


def _parts(spark: SparkSession, target_path: str) -> list[str]:
    line = read_line(spark, _folder(target_path))
    return line.split(",") if line else []


def key_ranges(spark: SparkSession, target_path: str) -> DataFrame:
    """file, band, low, high of all listed files."""
    parts = [f"{_folder(target_path)}/{p}" for p in _parts(spark, target_path)]
    return spark.read.schema(SCHEMA).parquet(*parts) if parts else spark.createDataFrame([], SCHEMA)


def _by_band(keys: DataFrame, pk: str, *more: Column) -> DataFrame:
    key = F.col(pk).cast("long")
    return keys.groupBy(*more, F.shiftright(key, BAND_BITS).alias("band")).agg(F.min(key).alias("low"), F.max(key).alias("high"))


def _files(target: DataFrame) -> dict[str, str]:
    """Name -> path of the files of a target."""
    return {f.rsplit("/", 1)[1]: f for f in target.inputFiles()}


def add_new_files(spark: SparkSession, target_path: str, spec: TableSpec) -> None:
    """List the files that have come since the last call: one pass over their key column."""
    if not _has_bands(spec):
        return
    files = _files(spark.read.schema(spec.full_schema).parquet(target_path))
    names = spark.createDataFrame([(n,) for n in files], "file string")
    new = [files[r.file] for r in names.join(key_ranges(spark, target_path).select("file").distinct(), "file", "left_anti").collect()]
    if not new:
        return
    before = _parts(spark, target_path)
    ranges = _by_band(spark.read.schema(spec.full_schema).parquet(*new), spec.pk, F.col("_metadata.file_name").alias("file"))
    added = _write(ranges, target_path)
    now = [*before, added]
    if len(now) > MAX_PARTS:
        whole = spark.read.schema(SCHEMA).parquet(*[f"{_folder(target_path)}/{p}" for p in now])
        now = [_write(whole.repartition("file"), target_path)]
        delete_path(spark, f"{_folder(target_path)}/{added}")
    write_line(spark, _folder(target_path), ",".join(now))
    for part in set(before) - set(now):
        delete_path(spark, f"{_folder(target_path)}/{part}")


def _write(ranges: DataFrame, target_path: str) -> str:
    name = uuid.uuid4().hex
    # in this order neighbours differ by little, and their differences are what is stored
    ranges.select("file", "band", "low", "high").sortWithinPartitions("file", "band").write.options(**PARQUET_OPTIONS).parquet(f"{_folder(target_path)}/{name}")
    return name


def _has_bands(spec: TableSpec) -> bool:
    return isinstance(spec.full_schema[spec.pk].dataType, (T.LongType, T.IntegerType, T.ShortType))


def may_hold(target: DataFrame, target_path: str, keys: DataFrame, spec: TableSpec) -> DataFrame | None:
    """The rows of those files of ``target`` (as read from ``target_path``) that may hold one of ``keys``; None if no file may."""
    if not _has_bands(spec) or not _parts(spark := target.sparkSession, target_path):
        return target
    wanted = _by_band(keys, spec.pk).select("band", F.col("low").alias("first"), F.col("high").alias("last"))
    meets = F.coalesce((F.col("low") <= F.col("last")) & (F.col("high") >= F.col("first")), F.lit(False))
    idle = key_ranges(spark, target_path).join(wanted, "band", "left").groupBy("file").agg(F.bool_or(meets).alias("meets")).where(~F.col("meets"))
    skip = {r.file for r in idle.collect()}
    files = _files(target)
    opened = [path for name, path in files.items() if name not in skip]
    if len(opened) == len(files):
        return target
    return spark.read.schema(target.schema).parquet(*opened) if opened else None
