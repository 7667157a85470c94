"""Helpers of the vector operators: valid vectors as a stored table, exact integer arithmetic on them, and an
exact search for the best rows of every query over segments of rows.

Search. Rows are dealt by hash into segments and queries into chunks of bounded size (``SEGMENT`` components).
One task scores one (segment, chunk) pair; neither side is broadcast or collected. A query first meets its home
segment only: the k-th score found there is a lower bound of its final one, and the other segments start from
it, so they score less and return few rows. Inside a task the rows form blocks with score bounds; ``search`` visits the blocks of all queries
in lockstep, best bound first, until the next bound lies below the k-th score found.

Defined results for all vector operators: rows whose vector is null or holds a null or non-finite component take no part;
vectors of different lengths are compared as if the shorter one ended in zeros; each row counts for itself, also where
a vec_id repeats; a null vec_id is a candidate like any other (last among ties) and never a query. Scores are exact and
saturate at the limits of a long; other columns are left behind, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import textbuf as tb

#: components of a segment of rows, and of a chunk of queries
SEGMENT = 1 << 22
#: a segment is not made smaller than this for the sake of more tasks
LEAST_ROWS = 1024
#: queries of a chunk that a task scores together
TOGETHER = 2048

_LONG = np.iinfo(np.int64)
_HUGE = np.finfo(np.float64).max


def valid_vectors(df: DataFrame, *more: Column, vector: str = "embedding", size: int | None = None) -> DataFrame:
    """row (a stored number of each row), vec_id (long), x (its components, as stored) and ``more`` of the rows that take part."""
    element = df.schema[vector].dataType.elementType
    x = F.col(vector) if isinstance(element, T.FloatType) else F.col(vector).cast("array<double>")
    ok = x.isNotNull() & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    if size is not None:
        ok = ok & (F.size(x) == size)
    rows = df.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), *more)
    return rows.select(F.monotonically_increasing_id().alias("row"), "*")


def matrix(column, scale: int, width: int = 0) -> np.ndarray:
    """floor(scale * x) of a list column as a float64 matrix (whole numbers), rows padded with zeros to the longest
    (``width`` at least)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    wide = max(width, int(lengths.max()) if n else 0)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(flat * scale), -_HUGE, _HUGE)
    if n and (lengths == wide).all():
        return flat.reshape(n, wide)
    out = np.zeros((n, wide))
    row = np.repeat(np.arange(n), lengths)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if n else np.zeros(0, np.int64)
    out[row, np.arange(len(flat)) - np.repeat(first, lengths)] = flat
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both padded with zeros to the wider one."""
    wide = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, wide - m.shape[1]))) if m.shape[1] < wide else m for m in (a, b))


def _python_ints(a: np.ndarray) -> np.ndarray:
    out = np.empty(a.shape, object)
    out[...] = [[int(v) for v in r] for r in a]
    return out


def saturated(values: np.ndarray) -> np.ndarray:
    """Python integers as int64, cut off at its limits."""
    return np.array([min(max(v, _LONG.min), _LONG.max) for v in values.ravel()], np.int64).reshape(values.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the whole-number rows of ``a`` and ``b``: exact, as int64. Doubles hold every partial sum
    exactly below 2**53; beyond that Python integers do the work."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    with np.errstate(over="ignore"):
        bound = np.abs(a).max() * np.abs(b).max() * a.shape[1]
    if bound < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return saturated(_python_ints(a) @ _python_ints(b).T)


def beyond_doubles(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether squared distances of rows of ``a`` and ``b`` may not fit into a double's whole numbers."""
    if not a.size or not b.size:
        return False
    with np.errstate(over="ignore"):
        return bool((np.abs(a).max() + np.abs(b).max()) ** 2 * a.shape[1] >= 2.0**52)


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances as Python integers."""
    x, y = _python_ints(a), _python_ints(b)
    return (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` and ``b``, exact, as int64 (saturating)."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if beyond_doubles(a, b):
        return saturated(exact_distances(a, b))
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)


class Found:
    """The ``k`` best rows of every slot so far: highest score first, ties by the rows' ``tie`` numbers. ``bar`` is what a
    score has to reach to matter: the k-th score once there are k, before that ``start``."""

    def __init__(self, k: int, start: np.ndarray, tie: np.ndarray):
        self.k, self.bar, self.tie = k, start.astype(np.float64), tie
        self.slot = self.score = self.row = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        slot, score, row = (np.concatenate([x, y]) for x, y in ((self.slot, slot), (self.score, score), (self.row, row)))
        order = np.lexsort((self.tie[row], ~score, slot))
        slot, score, row = slot[order], score[order], row[order]
        first = np.searchsorted(slot, slot, side="left")
        place = np.arange(len(slot)) - first
        kept = place < self.k
        last = place == self.k - 1
        self.bar[slot[last]] = np.maximum(self.bar[slot[last]], score[last])
        self.slot, self.score, self.row = slot[kept], score[kept], row[kept]


def search(high: np.ndarray, low: np.ndarray | None, floor: np.ndarray, ceiling: np.ndarray, found: Found, score: Callable) -> None:
    """Best rows of every query and window, exactly.

    ``high`` / ``low``: score bounds of queries x blocks (-inf: holds nothing for the query). ``floor``, ``ceiling``:
    queries x windows of whole scores that count; slot = query * windows + window. Every query takes its blocks by falling
    ``high``, one, then two, four ... a round, and ends when the next one lies below all its bars.
    ``score(block, queries)`` gives (rows of the block, scores queries x rows, and a mask or None)."""
    n, blocks = high.shape
    windows = floor.shape[1]
    bar = found.bar.reshape(n, windows)
    order = np.argsort(-high, axis=1, kind="stable")
    active, at, step = np.arange(n), 0, 1
    while True:
        # at most `at` blocks are behind every query that is still going
        if at >= blocks or not len(active):
            return
        going = high[active, order[active, at]]
        active = active[(going > -np.inf) & (going[:, None] >= bar[active]).any(1)]
        ahead = order[active, at : at + step]
        q, b = np.repeat(active, ahead.shape[1]), ahead.ravel()
        h = high[q, b]
        matters = (h[:, None] >= bar[q]) & (h > -np.inf)[:, None]
        if low is not None:
            matters &= low[q, b][:, None] <= ceiling[q]
        wanted = matters.any(1)
        q, b = q[wanted], b[wanted]
        by = np.argsort(b, kind="stable")
        q, b = q[by], b[by]
        cuts = np.flatnonzero(np.diff(b)) + 1
        hits = []
        for own in np.split(np.arange(len(b)), cuts):
            if not len(own):
                continue
            qs = q[own]
            rows, s, mask = score(int(b[own[0]]), qs)
            for w in range(windows):
                ok = (s >= bar[qs, w][:, None]) & (s >= floor[qs, w][:, None]) & (s <= ceiling[qs, w][:, None])
                i, j = np.nonzero(ok if mask is None else ok & mask)
                hits.append((qs[i] * windows + w, s[i, j], rows[j]))
        if hits:
            found.add(*(np.concatenate(x) for x in zip(*hits)))
        at += step
        step *= 2


def ties(ids: pa.ChunkedArray) -> np.ndarray:
    """Place of every row by id, nulls last."""
    null = ids.is_null().to_numpy()
    known = pc.fill_null(ids, 0).to_numpy()
    out = np.empty(len(known), np.int64)
    out[np.lexsort((known, null))] = np.arange(len(known))
    return out


FOUND = "query long, slot int, vec_id long, score long"


def found_table(found: Found, windows: int, queries: np.ndarray, ids: pa.ChunkedArray) -> pa.Table:
    return pa.table(
        {
            "query": pa.array(queries[found.slot // windows], pa.int64()),
            "slot": pa.array(found.slot % windows, pa.int32()),
            "vec_id": ids.combine_chunks().take(pa.array(found.row)),
            "score": pa.array(found.score, pa.int64()),
        }
    )


def search_all(rows: DataFrame, queries: DataFrame, task: Callable, k: int) -> DataFrame:
    """(query, slot, vec_id, score) of the ``k`` best rows of every query and slot, and their ``rank``.

    ``rows`` and ``queries``: stored tables with ``row`` and ``x``. ``task(rows, queries)`` searches one pair of Arrow
    tables; queries carry ``seed``, the k-th scores found so far by slot (a list; null where fewer are known), and both sides the columns of the caller."""
    spark = rows.sparkSession
    count = lambda df: df.agg(F.count("*"), F.coalesce(F.sum(F.size("x")), F.lit(0))).first()
    (n, size), (asked, width) = count(rows), count(queries)
    segments = max(1, -(-size // SEGMENT), min(tb.shuffle_tasks(spark), -(-n // LEAST_ROWS)))
    chunks = max(1, -(-width // SEGMENT))
    part = lambda salt, parts: F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(parts)).cast("int")
    rows = rows.withColumn("segment", part(1, segments))
    # own column identities: queries are rows of the same table
    queries = queries.toDF(*queries.columns).withColumn("home", part(2, segments)).withColumn("chunk", part(3, chunks))
    run = lambda key, left, right: task(left, right)

    at_home = queries.withColumn("seed", F.lit(None).cast("array<long>")).withColumnRenamed("home", "segment").drop("chunk")
    first = rows.groupBy("segment").cogroup(at_home.groupBy("segment")).applyInArrow(run, FOUND)
    first = tb.materialized(first, "best-at-home")
    if segments > 1:
        full = first.groupBy("query", "slot").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        slots = 1 + (full.agg(F.max("slot")).first()[0] or 0)
        per_slot = [F.max(F.when(F.col("slot") == s, F.col("kth"))) for s in range(slots)]
        seeds = full.groupBy(F.col("query").alias("row")).agg(F.array(*per_slot).alias("seed"))
        abroad = queries.join(seeds, "row", "left").withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))).where("segment <> home").drop("home")
        copies = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        rest = copies.groupBy("segment", "chunk").cogroup(abroad.groupBy("segment", "chunk")).applyInArrow(run, FOUND)
        first = first.unionByName(rest)
    best = Window.partitionBy("query", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def seeds(column: pa.ChunkedArray, windows: int) -> np.ndarray:
    """The ``seed`` lists as queries x windows (-inf where unknown)."""
    out = np.full((len(column), windows), -np.inf)
    for i, s in enumerate(column.to_pylist()):
        for w, v in enumerate((s or [])[:windows]):
            if v is not None:
                out[i, w] = v
    return out
