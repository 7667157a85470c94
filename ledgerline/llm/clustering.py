"""Exact Lloyd clustering of integer vectors with ns-bounds (norm of the summed displacement).

Every vector keeps, for its own centroid an upper and for every other one a lower bound of the distance, together with the round
in which that distance was last computed. The history of all centroids is retained, so a bound is loosened by the
norm of the centroid's total displacement since that round, |C_now - C_then|, which never exceeds the sum of its per-round drifts.
A centroid whose loosened lower bound lies above the loosened upper bound cannot be the nearest. If any other fails, the own distance is computed exactly, then
those that still fail; ties go to the smaller number, so equal bounds fail too. Distances are compared as exact integers; bounds are
rounded outwards. Rows and centroids whose distances a double cannot hold are compared as Python integers, without bounds.

Each round is one pass over the stored state (vector, cluster, bounds) that writes the next state, and one aggregation of
componentwise sums: tasks send k partial sums of each Arrow batch, and the driver gets the k x d totals. The previous state is deleted once
the next one is written, so two are on disk at most; a lost executor costs its own tasks.

Defined results: vectors that are null, of another length, or hold a null or non-finite component take no part; with fewer than ``k`` vectors
each is a centroid; an empty table gives no rows. Equal hashes (repeated ids) are ordered by the vectors' components, a null vec_id
(no hash) comes last. Distances and inertias saturate at the limits of a long; other columns are left behind.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb
from ledgerline.llm import vectors as V

K, ROUNDS, SIZE, SCALE = 16, 3, 64, 64
#: bounds are stored as floats: far more than their rounding
OUT, IN = 1 + 1e-6, 1 - 1e-6
#: rows of a batch that are worked on together
TOGETHER = 4096


def _whole(values) -> np.ndarray:
    """Centroids (lists of Python integers) as whole-number doubles, exact up to 2**53, and saturating beyond the doubles."""
    return np.array([[float(min(max(v, -int(V._HUGE)), int(V._HUGE))) for v in row] for row in values], np.float64)


def _gap(now: np.ndarray, then: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num(np.sqrt(((now - then) ** 2).sum(-1)), nan=np.inf) * OUT


def _assign(history: list[np.ndarray], scale: int):
    """Next state of rows (row, vec_id, x, cluster, distance, low, seen) under the last centroids of ``history``; rows without
    a cluster are new. ``moved`` and ``computed`` count what the bounds left to do."""
    now, t = history[-1], len(history) - 1
    k = len(now)
    # norm of the total displacement of every centroid since each round
    displaced = np.stack([_gap(now, then) for then in history])  # rounds x k

    def step(x, cluster, low, seen):
        n = len(x)
        every = np.arange(n)
        if V.beyond_doubles(x, np.concatenate(history)):
            # no bound holds here: all distances as Python integers, and bounds that fail next time
            d = V.exact_distances(x, now)
            cluster = d.argmin(1)
            low = np.zeros((n, k), np.float32)
            low[every, cluster] = np.inf
            return cluster, V.saturated(d[every, cluster]), low, np.full((n, k), t, np.uint16), n * k
        if t == 0:
            d = V.distances(x, now)
            cluster = d.argmin(1)
            return cluster, d[every, cluster], np.sqrt(d.astype(np.float64)), np.zeros((n, k), np.uint16), n * k
        moved = displaced[seen, np.arange(k)[None]]
        own = np.zeros((n, k), bool)
        own[every, cluster] = True
        bound = np.where(own, low * OUT + moved, np.maximum(low * IN - moved, 0))
        fails = (bound <= bound[every, cluster][:, None] * OUT) & ~own
        distance = np.full(n, -1, np.int64)
        computed = 0
        look = np.flatnonzero(fails.any(1))
        if len(look):
            # the own distance first: it may settle the others
            for c in np.unique(cluster[look]):
                r = look[cluster[look] == c]
                distance[r] = V.distances(x[r], now[c : c + 1])[:, 0]
            exact = np.sqrt(distance[look].astype(np.float64))
            computed += len(look)
            low[look, cluster[look]], seen[look, cluster[look]] = exact, t
            fails[look] &= bound[look] <= exact[:, None] * OUT
            best, at = distance.copy(), cluster.copy()
            for c in range(k):
                r = look[fails[look, c]]
                if not len(r):
                    continue
                d = V.distances(x[r], now[c : c + 1])[:, 0]
                computed += len(r)
                low[r, c], seen[r, c] = np.sqrt(d.astype(np.float64)), t
                nearer = (d < best[r]) | ((d == best[r]) & (c < at[r]))
                best[r[nearer]], at[r[nearer]] = d[nearer], c
            distance, cluster = best, at
        return cluster, distance, low, seen, computed

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER):
                b = batch.slice(lo, TOGETHER)
                x = V.matrix(b.column("x"), scale)
                n = len(x)
                cluster = low = seen = None
                if t:
                    cluster = b.column("cluster").to_numpy().astype(np.int64)
                    low = np.frombuffer(b"".join(b.column("low").to_pylist()), np.float32).reshape(n, k).astype(np.float64)
                    seen = np.frombuffer(b"".join(b.column("seen").to_pylist()), np.uint16).reshape(n, k).copy()
                cluster, distance, low, seen, computed = step(x, cluster, low, seen)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(c) for c in ("row", "vec_id", "x")),
                        pa.array(cluster, pa.int32()),
                        pa.array(distance, pa.int64()),
                        pa.array([r.tobytes() for r in low.astype(np.float32)], pa.binary()),
                        pa.array([r.tobytes() for r in seen], pa.binary()),
                        pa.array(np.full(n, computed / max(n, 1))),
                    ],
                    ["row", "vec_id", "x", "cluster", "distance", "low", "seen", "computed"],
                )

    return run


def _sums(scale: int):
    """Partial sums (cluster, place, total) of each batch; place -1 counts the rows. Totals as decimal text: any size."""

    def run(batches):
        for b in batches:
            x, cluster = V.matrix(b.column("x"), scale), b.column("cluster").to_numpy()
            c, p, s = [], [], []
            small = not x.size or np.abs(x).max() < 2.0**62 / max(len(x), 1)
            for k in np.unique(cluster):
                own = x[cluster == k]
                total = own.astype(np.int64).sum(0).tolist() if small else V._python_ints(own).sum(0).tolist()
                c += [int(k)] * (len(total) + 1)
                p += [-1, *range(len(total))]
                s += [str(len(own)), *map(str, total)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(p, pa.int32()), pa.array(s, pa.string())], ["cluster", "place", "total"])

    return run


def _means(state: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """floor(sum / count) of every non-empty cluster; the others stay."""
    parts = state.select("x", "cluster").mapInArrow(_sums(scale), "cluster int, place int, total string")
    number = F.col("total").try_cast("decimal(38,0)")
    # sums that a decimal cannot hold (components beyond 10^30) are added as text, a partial sum at a time, in `exact`
    totals = parts.groupBy("cluster", "place").agg(F.try_sum(number).alias("s"), F.count_if(number.isNull()).alias("wide")).collect()
    out = [list(c) for c in centroids]
    sums = {(r.cluster, r.place): int(r.s) for r in totals if r.s is not None and not r.wide}
    for r in totals:
        if (r.cluster, r.place) not in sums:
            sums[r.cluster, r.place] = _exact_sum(parts.where((F.col("cluster") == r.cluster) & (F.col("place") == r.place)).select("total"))
    for c in range(len(out)):
        if n := sums.get((c, -1)):
            out[c] = [sums[c, p] // n for p in range(len(out[c]))]
    return out


def _exact_sum(parts: DataFrame) -> int:
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([str(sum(int(v) for b in batches for v in b.column("total").to_pylist()))])], ["total"])

    return sum(int(r.total) for r in parts.mapInArrow(run, "total string").toLocalIterator())


def first_centroids(rows: DataFrame, k: int, scale: int, salt: str = "1:") -> list[list[int]]:
    """The vectors of smallest sha256 of salt and vec_id."""
    h = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    low = rows.select(h.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(k).toArrow()
    return [[int(v) for v in r] for r in V.matrix(low.column("x"), scale)]


def assignments(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(stored state after the last assignment, final centroids as integers)."""
    state = tb.materialized(V.valid_vectors(embeddings, size=size), "kept-vectors")
    schema = f"row long, vec_id long, x {state.schema['x'].dataType.simpleString()}, cluster int, distance long, low binary, seen binary, computed double"
    centroids = first_centroids(state, k, scale)
    if not centroids:
        return state.sparkSession.createDataFrame([], schema), centroids
    history = [_whole(centroids)]
    for t in range(rounds + 1):
        before = state
        state = tb.materialized(state.mapInArrow(_assign(list(history), scale), schema), f"clusters-{t}")
        tb.discard(before)
        if t < rounds:
            centroids = _means(state, centroids, scale)
            history.append(_whole(centroids))
    return state, centroids


def _final(centroids: np.ndarray, scale: int):
    """Distance to the own centroid of the rows whose bounds settled their last assignment without it."""

    def run(batches):
        for b in batches:
            distance, cluster = b.column("distance").to_numpy().copy(), b.column("cluster").to_numpy()
            for c in np.unique(cluster[distance < 0]):
                r = np.flatnonzero((cluster == c) & (distance < 0))
                distance[r] = V.distances(V.matrix(b.column("x").take(pa.array(r)), scale), centroids[c : c + 1])[:, 0]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("cluster"), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def _long(total) -> F.Column:
    return F.least(total, F.lit(V._LONG.max).cast("decimal(38,0)")).cast("long")


def cluster(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    state, centroids = assignments(embeddings, k, rounds, size, scale)
    spark = embeddings.sparkSession
    held = state.select("vec_id", "cluster", "distance", "x")
    rows = held.mapInArrow(_final(_whole(centroids), scale), "vec_id long, cluster int, distance long") if centroids else held.drop("x")
    rows = tb.materialized(rows, "distances")
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    per = [(r.cluster, int(r.s)) for r in per.collect()]  # k rows
    everything = min(sum(s for _, s in per), V._LONG.max)
    named = [(c, min(s, V._LONG.max), everything, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in per]
    table = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
