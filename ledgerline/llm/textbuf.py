"""Byte-level helpers shared by the operators: Arrow text columns as numpy buffers,
word runs and their hashes, bounded slices of a batch.

Memory of every helper is proportional to the slice it is given, and slices are
bounded by ``SLICE_BYTES`` (one longer text makes a slice of its own).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

SLICE_BYTES = 1 << 19

_rng = np.random.RandomState(20240517)
#: one random 64-bit value for each byte
BYTE_VALUE = (_rng.randint(0, 1 << 32, 256, dtype=np.uint64) << np.uint64(32)) | _rng.randint(0, 1 << 32, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls count as empty texts."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``limit`` bytes (one row at least)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_slices(batches, limit: int = SLICE_BYTES, column: str = "text"):
    """(rows of the batch, bytes, offsets) for bounded runs of rows."""
    for batch in batches:
        data, off = buffers(batch.column(column))
        for lo, hi in slices(off, limit):
            yield batch.slice(lo, hi - lo), data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
    give_back()


def give_back() -> None:
    """Hand memory that a task has freed back to the system: a worker that waits for its next task otherwise keeps what its
    largest slice took (where the C library is not glibc, only Arrow's part goes)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal True runs that do not cross the row bounds in ``offsets``."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = mask[inner]
    last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    out = []
    with np.errstate(over="ignore"):
        for base in (_BASE, _INVERSE):
            power = np.full(n, base, np.uint64)
            power[:1] = 1
            out.append(np.multiply.accumulate(power, out=power))
    return out[0], out[1]


#: powers for a whole slice, made when first needed; a longer text makes its own
_SLICE_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of the bytes of each run (runs not empty). Runs that cover most of the bytes between them are
    differences of running sums of byte values times powers of the base, divided by the power at their start; others are summed up one by one."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    lo, hi = int(starts.min()), int(ends.max())
    with np.errstate(over="ignore"):
        h = _dense_sums(data[lo:hi], starts - lo, ends - lo) if 3 * int(lengths.sum()) > 2 * (hi - lo) else _sparse_sums(data, starts, lengths)
        h += lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix64(h)


def _dense_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    if n <= SLICE_BYTES and not _SLICE_POWERS:
        _SLICE_POWERS.append(_powers(SLICE_BYTES))
    power, inverse = _SLICE_POWERS[0] if n <= SLICE_BYTES else _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.take(BYTE_VALUE, data, out=total[1:], mode="clip")  # "clip" saves a copy
    total[1:] *= power[:n]
    np.cumsum(total, out=total)
    return (total[ends] - total[starts]) * inverse[starts]


def _sparse_sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    longest = int(lengths.max())
    power = np.empty(longest, np.uint64)
    power[0] = 1
    if longest > 1:
        power[1:] = _BASE
        np.multiply.accumulate(power, out=power)
    total = int(lengths.sum())
    first = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    local = np.arange(total, dtype=np.int64) - np.repeat(first, lengths)
    v = BYTE_VALUE[data[np.repeat(starts, lengths) + local]]
    v *= power[local]
    return np.add.reduceat(v, first)


def row_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row index of each position (positions lie inside texts)."""
    return np.searchsorted(offsets, positions, side="right") - 1


def lookup(size: int, chars: bytes, invert: bool = False) -> np.ndarray:
    t = np.zeros(size, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return ~t if invert else t


#: bytes of `[^\x20\x09-\x0D]` words
WORD_BYTE = lookup(256, bytes([0x20, *range(0x09, 0x0E)]), invert=True)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, other bytes as they are."""
    return np.frombuffer(bytes(data).translate(LOWER), np.uint8)


LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: bytes of rows that Spark hands to a Python worker at once: both sides hold such a batch, Spark in memory outside its heap
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on cuts Arrow batches at BATCH_BYTES, if it has Spark's 64 MB; a value that the caller has set stays."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) in (None, "67108864b"):
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df


def id_text(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id (long) and text (string) of any documents table; other columns are left behind."""
    return bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: shuffle partitions that share a file of a narrow table, as long as every core has a file to write
PARTITIONS_A_FILE = 16


def materialized(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: later
    steps start from that table, so a lost executor costs no more than its own tasks.

    ``narrow``: rows of a few numbers that come out of a shuffle. One task writes those of several partitions: on a local file
    system an executor starts three processes (to set permissions) for each file."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    if narrow:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, shuffle_tasks(spark) // PARTITIONS_A_FILE))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame of ``schema`` that no Python worker takes part in (one made of a Python list starts a daemon and two
    workers of its own in every executor)."""
    return spark.range(0).select(F.from_json(F.lit("{}"), schema).alias("row")).select("row.*")


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialized`` wrote and nothing reads any more."""
    from ledgerline.sources.files import delete_path

    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        delete_path(df.sparkSession, path)


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it holds at most ``max_rows`` rows; otherwise as it is,
    for a shuffle join. The caller's columns are a few fixed-width values, so rows bound bytes."""
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


#: words of 64 bits of a key filter: 2^20 rows of two numbers when it is sent to a scan, whatever the number of keys
FILTER_WORDS = 1 << 20


def _bit(*keys: str) -> tuple[Column, Column]:
    h = F.xxhash64(F.lit(77), *keys)
    return F.pmod(h, F.lit(FILTER_WORDS)).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(h, 40), F.lit(64)).cast("int"))


def key_filter(keys: DataFrame, *names: str) -> DataFrame:
    """A bitmap of hashed keys as a table (word, mask) of at most FILTER_WORDS rows, with a broadcast hint. It names every
    key and, the more keys there are, some others; exact joins follow on what it lets through."""
    word, bit = _bit(*names)
    bits = keys.select(word.alias("llm_word"), bit.alias("llm_bit")).groupBy("llm_word").agg(F.bit_or("llm_bit").alias("llm_mask"))
    return F.broadcast(materialized(bits, "key-filter", narrow=True))


def split_by_filter(df: DataFrame, bits: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the filter, rows whose key is not)."""
    word, bit = _bit(*names)
    met = df.withColumns({"llm_word": word, "llm_bit": bit}).join(bits, "llm_word", "left")
    named = F.coalesce(F.col("llm_mask").bitwiseAND(F.col("llm_bit")) != 0, F.lit(False))
    return met.where(named).select(*df.columns), met.where(~named).select(*df.columns)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
