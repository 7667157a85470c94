"""Exact top-k inner-product search by block-at-a-time pruning.

The terms of a vector are its signed dimensions: a positive component weighs in on (d, +), a negative one on (d, -). A task
orders the rows of its segment by their strongest terms and cuts them into blocks of ``BLOCK``; a block keeps the maximum of
each term over its rows and a forward index (its rows' components). The bound of a query and a block is the sum of the query's term weights
times the block's term maxima: no row of the block scores higher. Every query takes the blocks by falling bound, scores them through their forward indexes,
and stops when the next bound falls below its k-th score; equal bounds go on, since a tie may have a smaller id. See ``vectors``
for how rows and queries are dealt to tasks, and for the defined results on null, ragged and repeated vectors.
Fewer than k candidates: all of them; an empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb
from ledgerline.llm import vectors as V

BLOCK = 64
SCALE = 1024
K = 10


def _blocks(x: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the maxima of the 2 d terms of each block."""
    size = np.abs(x)
    n, d = x.shape
    if not d:
        return np.arange(n), np.zeros((-(-n // block), 0))
    strongest = np.argsort(-size, axis=1, kind="stable")[:, : min(3, d)]
    signed = strongest * 2 + (np.take_along_axis(x, strongest, 1) < 0)
    order = np.lexsort(tuple(signed[:, c] for c in range(signed.shape[1] - 1, -1, -1)))
    first = np.arange(0, n, block)
    y = x[order]
    return order, np.concatenate([np.maximum.reduceat(y, first), np.maximum.reduceat(-y, first)], axis=1)


def _search(k: int, scale: int, block: int):
    def task(rows: pa.Table, queries: pa.Table) -> pa.Table:
        ids = rows.column("vec_id")
        if not rows.num_rows or not queries.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "slot": pa.array([], pa.int32()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        x, q = V.same_width(V.matrix(rows.column("x"), scale), V.matrix(queries.column("x"), scale))
        own, asked = rows.column("row").to_numpy(), queries.column("row").to_numpy()
        tie, bars = V.ties(ids), V.seeds(queries.column("seed"), 1)
        order, maxima = _blocks(x, block)
        forward = x[order]
        out = []
        for lo in range(0, len(q), V.TOGETHER):
            part, who = q[lo : lo + V.TOGETHER], asked[lo : lo + V.TOGETHER]
            weights = np.concatenate([np.maximum(part, 0), np.maximum(-part, 0)], axis=1)
            # a block's maximum below zero lowers the bound: the query's weight on that term meets at most that much
            with np.errstate(over="ignore", invalid="ignore"):
                high = weights @ maxima.T
                high += 1e-9 * np.abs(high) + (0.0 if np.abs(high).max(initial=0) < 2.0**52 else 1e-9 * (weights @ np.abs(maxima).T))
            high = np.where(np.isnan(high), np.inf, high)

            def score(b, qs):
                rows_ = order[b * block : (b + 1) * block]
                return rows_, V.products(part[qs], forward[b * block : (b + 1) * block]), own[rows_][None] != who[qs][:, None]

            n = len(part)
            found = V.Found(k, bars[lo : lo + V.TOGETHER].ravel(), tie)
            V.search(high, None, np.full((n, 1), V._LONG.min), np.full((n, 1), V._LONG.max), found, score)
            out.append(V.found_table(found, 1, who, ids))
        return pa.concat_tables(out)

    return task


def top_k(embeddings: DataFrame, every: int = 100, k: int = K, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every`` the ``k`` other rows of highest
    inner product of the vectors floor(scale * x), ties to the smaller vec_id."""
    rows = tb.materialized(V.valid_vectors(embeddings), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    best = V.search_all(rows, queries, _search(k, scale, block), k)
    names = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return best.join(names, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
