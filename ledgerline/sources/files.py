"""Folder operations on the session's file systems: existence, small numbered logs, versioned folders.

A log is a folder of small numbered files. An entry is written under a hidden name and renamed to the next number, which
never exists before, so no file is ever replaced or half written: a reader takes the highest number and sees
the state before or after an entry, whatever else happens. State lines (watermarks) and commits are such logs.

A versioned folder holds complete snapshots below ``_snapshots`` and the log ``_commits`` of their names. Publishing a
snapshot is one log entry. Readers resolve the last entry and never repair anything; a snapshot that no commit
names (a writer was killed) is never read and goes with the next publication. The last ``KEEP_SNAPSHOTS`` snapshots stay, so a
query that resolved the previous one can finish. One writer at a time is assumed.

The only module that uses the JVM gateway of a classic session; Spark Connect has none, so
these calls fail there with a clear error instead of guessing. File-system errors always reach the
caller: a load that cannot tell whether its target exists must not go on.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

SNAPSHOTS, COMMITS = "_snapshots", "_commits"
KEEP_SNAPSHOTS = 2
#: entries that stay in a log; a reader that is overtaken by more of them looks again
KEEP_ENTRIES = 8
#: writer options of targets and of tables that a job stores for its next step: keys, times and positions lie close together, so
#: their differences are stored
PARQUET_OPTIONS = {"compression": "zstd", "parquet.writer.version": "v2"}


def _fs(spark: SparkSession, path: str):
    try:
        context = spark.sparkContext
        jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    except Exception as exc:
        raise RuntimeError(
            "loading needs a classic Spark session: folders are published through its Hadoop file system"
        ) from exc
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def _missing(exc: Py4JJavaError) -> bool:
    return exc.java_exception.getClass().getName() == "java.io.FileNotFoundException"


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a completely written folder to a path that does not exist."""
    fs, p, jvm = _fs(spark, path)
    target = jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(target) or not fs.rename(p, target):
        raise OSError(f"could not move {path} to {to}: is there another writer?")


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, p, _ = _fs(spark, folder)
    try:
        return [s.getPath().getName() for s in fs.listStatus(p)]
    except Py4JJavaError as exc:
        if _missing(exc):
            return []
        raise


def _read_file(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()


# ------------------------------------------------------------------ logs
def _entries(spark: SparkSession, log: str) -> list[int]:
    return sorted(int(n) for n in _names(spark, log) if n.isdigit())


def _entry(log: str, number: int) -> str:
    return f"{log}/{number:020d}"


def _last_lines(spark: SparkSession, log: str, count: int) -> list[str]:
    """The newest lines of a log, newest first."""
    while True:
        numbers = _entries(spark, log)
        try:
            return [_read_file(spark, _entry(log, n)) for n in numbers[::-1][:count]]
        except Py4JJavaError as exc:
            # an entry went while it was read: a writer has added many since; look again
            if not _missing(exc) or _entries(spark, log) == numbers:
                raise


def last_line(spark: SparkSession, log: str) -> str | None:
    """Newest line of a log; None if it has none."""
    lines = _last_lines(spark, log, 1)
    return lines[0] if lines else None


def add_line(spark: SparkSession, log: str, line: str) -> None:
    """Append a line; the rename to its number is the moment it counts."""
    numbers = _entries(spark, log)
    fs, staged, jvm = _fs(spark, f"{log}/.entry-{uuid.uuid4().hex[:12]}")
    out = fs.create(staged, True)
    try:
        out.write(bytearray(line.encode("utf-8")))
    finally:
        out.close()
    final = jvm.org.apache.hadoop.fs.Path(_entry(log, numbers[-1] + 1 if numbers else 1))
    if fs.exists(final) or not fs.rename(staged, final):
        fs.delete(staged, False)
        raise OSError(f"could not add to {log}: is there another writer?")
    for n in numbers[:-KEEP_ENTRIES]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(_entry(log, n)), False)


def _log_of(path: str) -> str:
    return f"{path.rstrip('/')}.log"


def read_line(spark: SparkSession, path: str) -> str | None:
    """The state line kept under ``path``; None if there is none."""
    line = last_line(spark, _log_of(path))
    if line is None and path_exists(spark, path):  # written as a plain file before there were logs
        return _read_file(spark, path)
    return line


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """Set the state line kept under ``path``; readers see the old or the new line."""
    add_line(spark, _log_of(path), line)


def delete_line(spark: SparkSession, path: str) -> None:
    delete_path(spark, path)
    delete_path(spark, _log_of(path))


# ------------------------------------------------------------------ versioned folders
def new_snapshot(path: str) -> str:
    """Where to write the next snapshot of a versioned folder."""
    return f"{path.rstrip('/')}/{SNAPSHOTS}/{uuid.uuid4().hex}"


def current_snapshot(spark: SparkSession, path: str) -> str:
    """The folder that holds the current rows of ``path``: the last published snapshot, or the folder itself where
    none was ever published (appended targets)."""
    path = path.rstrip("/")
    name = last_line(spark, f"{path}/{COMMITS}")
    return path if name is None else f"{path}/{SNAPSHOTS}/{name}"


def holds_table(spark: SparkSession, folder: str) -> bool:
    """Whether a plain folder holds anything a table reader sees (or the mark of a completed write)."""
    return any(n == "_SUCCESS" or not n.startswith(("_", ".")) for n in _names(spark, folder))


def publish_snapshot(spark: SparkSession, path: str, snapshot: str) -> None:
    """Make a completely written snapshot the current one, then drop those no reader can still resolve."""
    path = path.rstrip("/")
    fs, complete, jvm = _fs(spark, f"{snapshot}/_SUCCESS")
    if not fs.exists(complete):
        raise OSError(f"{snapshot} is not a complete snapshot")
    add_line(spark, f"{path}/{COMMITS}", snapshot.rstrip("/").rsplit("/", 1)[1])
    kept = _last_lines(spark, f"{path}/{COMMITS}", KEEP_SNAPSHOTS)
    for name in _names(spark, f"{path}/{SNAPSHOTS}"):
        if name not in kept:
            delete_path(spark, f"{path}/{SNAPSHOTS}/{name}")
    if len(kept) == KEEP_SNAPSHOTS:  # rows of an unversioned folder are older than both
        for name in _names(spark, path):
            if not name.startswith(("_", ".")):
                delete_path(spark, f"{path}/{name}")


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write ``df`` as a new, not yet published snapshot of ``path``; a failed write leaves nothing behind."""
    snapshot = new_snapshot(path)
    try:
        df.write.options(**PARQUET_OPTIONS).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(snapshot)
    except BaseException:
        delete_path(df.sparkSession, snapshot)
        raise
    return snapshot
