"""Hard negatives by angular triangle filtering.

Index. ``REFERENCES`` directions are fitted on a bounded sample (``SAMPLE`` vectors, smallest hash of the row number; a few rounds of
spherical k-means). Every vector is stored with its norm and its angles to all references. For vectors a, x and any
reference r the triangle inequality on the sphere gives |a^r - x^r| <= a^x <= min(a^r + x^r, 2 pi - a^r - x^r): the tightest interval
over the references, widened by ``SLACK`` radians, as cosines times the two norms and widened by one, bounds the
integer score from both sides.

A task orders its rows by label, nearest reference and angle to it and cuts blocks of one label; the ranges of a block's angles and norms
bound the scores of all its rows with an anchor. Blocks, then rows, whose bounds meet no window are left out; only
the rest is scored in integers (see ``vectors`` for the search and for the defined results on null, ragged and repeated vectors).

Two searches: the best rows of the anchor's own label are its positives, with the window of all scores; then each
positive's score p gives the window [low * p / 100, p] over the rows of other labels.

Rows with a null label take no part. A positive without a negative in its window gives no rows; so do negative p, whose window
is empty. An anchor with fewer positives or negatives than asked gets all there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb
from ledgerline.llm import vectors as V

SCALE = 256
REFERENCES, SAMPLE, ROUNDS = 16, 4096, 4
BLOCK = 64
#: added to an angle interval: far above the rounding of arccos near 0 and pi and of angles stored as floats
SLACK = 1e-5
POSITIVES, NEGATIVES, LOW = 5, 5, 80


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions, norms); a zero vector has norm 0 and any direction."""
    if not x.shape[1]:
        return x, np.zeros(len(x))
    top = np.abs(x).max(1)
    safe = np.where(top > 0, top, 1)
    y = x / safe[:, None]
    length = np.sqrt((y * y).sum(1))
    with np.errstate(over="ignore"):
        return y / np.where(length > 0, length, 1)[:, None], length * top


def fit_references(sample: np.ndarray, count: int = REFERENCES, rounds: int = ROUNDS) -> np.ndarray:
    """Unit directions spread over the sample: farthest first, then means of the nearest vectors."""
    unit, norm = _unit(sample)
    unit = unit[norm > 0]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(count, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    refs = unit[chosen]
    for _ in range(rounds):
        own = (unit @ refs.T).argmax(1)
        sums = np.zeros_like(refs)
        np.add.at(sums, own, unit)
        mean, length = _unit(sums)
        refs = np.where((length > 0)[:, None], mean, refs)
    return refs


def _angles(refs: np.ndarray, scale: int):
    """Adds norm, angles (one a reference) and the nearest reference."""

    def run(batches):
        for b in batches:
            x, r = V.same_width(V.matrix(b.column("x"), scale), refs)
            unit, norm = _unit(x)
            angle = np.arccos(np.clip(unit @ r.T, -1, 1)).astype(np.float32)
            near = angle.argmin(1) if len(r) else np.zeros(len(x), np.int64)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(r), angle.ravel())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norm), lists, pa.array(near, pa.int32())], [*b.schema.names, "norm", "angles", "near"])

    return run


def _interval(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest possible angle between anchors (angles ``a``: anchors x references) and rows whose angles lie
    in [lo, hi] (rows x references)."""
    least, most = np.zeros((len(a), len(lo))), np.full((len(a), len(lo)), np.pi)
    for i in range(a.shape[1]):
        x, u, v = a[:, i : i + 1], lo[None, :, i], hi[None, :, i]
        np.maximum(least, np.maximum(x - v, u - x), out=least)
        # the sum, folded back at pi
        far = np.where((x + u <= np.pi) & (x + v >= np.pi), np.pi, np.maximum(np.minimum(x + u, 2 * np.pi - x - u), np.minimum(x + v, 2 * np.pi - x - v)))
        np.minimum(most, far, out=most)
    return np.clip(least - SLACK, 0, np.pi), np.clip(most + SLACK, 0, np.pi)


def _scores(least: np.ndarray, most: np.ndarray, na: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) bounds of whole scores from angle intervals and norms (anchors; rows or blocks within [lo, hi])."""
    with np.errstate(over="ignore", invalid="ignore"):
        top, bottom = np.cos(least), np.cos(most)
        high = top * na[:, None] * np.where(top >= 0, hi[None], lo[None])
        low = bottom * na[:, None] * np.where(bottom >= 0, lo[None], hi[None])
        slack = 1 + 1e-9 * na[:, None] * hi[None]
        # scores saturate at the limits of a long, and so do their bounds
        low, high = np.nan_to_num(low - slack, nan=-np.inf), np.nan_to_num(high + slack, nan=np.inf)
        return np.clip(low, -(2.0**63), 2.0**63), np.clip(high, -(2.0**63), 2.0**63)


def _list_matrix(column, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, width) if width else np.zeros((len(column), 0))


def _search(references: int, k: int, scale: int, same: bool, windows: int, block: int = BLOCK):
    """Search one pair of tables; ``same``: rows of the anchor's label, else of the others, in the anchor's windows."""

    def task(rows: pa.Table, queries: pa.Table) -> pa.Table:
        ids = rows.column("vec_id")
        if not rows.num_rows or not queries.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "slot": pa.array([], pa.int32()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        x, q = V.same_width(V.matrix(rows.column("x"), scale), V.matrix(queries.column("x"), scale))
        angle, norm = _list_matrix(rows.column("angles"), references), rows.column("norm").to_numpy()
        label, near = rows.column("label").to_numpy(), rows.column("near").to_numpy()
        asked, wanted = queries.column("row").to_numpy(), queries.column("label").to_numpy()
        qangle, qnorm = _list_matrix(queries.column("angles"), references), queries.column("norm").to_numpy()
        own, tie, bars = rows.column("row").to_numpy(), V.ties(ids), V.seeds(queries.column("seed"), windows)
        order = np.lexsort((angle[np.arange(len(near)), near] if references else near, near, label))
        x, angle, norm, label, own = x[order], angle[order], norm[order], label[order], own[order]
        # blocks of one label
        start = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
        run = np.diff(np.concatenate([start, [len(label)]]))
        place = np.arange(len(label)) - np.repeat(start, run)
        first = np.flatnonzero(place % block == 0)
        end = np.concatenate([first[1:], [len(label)]])
        b_lo, b_hi = np.minimum.reduceat(angle, first), np.maximum.reduceat(angle, first)
        n_lo, n_hi = np.minimum.reduceat(norm, first), np.maximum.reduceat(norm, first)
        least, most = np.full((len(q), windows), V._LONG.min), np.full((len(q), windows), V._LONG.max)
        if not same:
            most[:] = V._LONG.min  # no such window
            least[:] = V._LONG.max
            for i, w in enumerate(queries.column("windows").to_pylist()):
                for slot, p in enumerate(w):
                    if p is not None:
                        least[i, slot], most[i, slot] = -((-LOW * p) // 100), p
        out = []
        for lo in range(0, len(q), V.TOGETHER):
            part, who = q[lo : lo + V.TOGETHER], asked[lo : lo + V.TOGETHER]
            qa, qn, ql = qangle[lo : lo + V.TOGETHER], qnorm[lo : lo + V.TOGETHER], wanted[lo : lo + V.TOGETHER]
            floor, ceiling = least[lo : lo + V.TOGETHER], most[lo : lo + V.TOGETHER]
            low, high = _scores(*_interval(qa, b_lo, b_hi), qn, n_lo, n_hi)
            other = ql[:, None] != label[first][None]
            high[other if same else ~other] = -np.inf
            n = len(part)
            bar = np.where(floor > ceiling, np.inf, np.maximum(floor, bars[lo : lo + V.TOGETHER]))
            if same:
                bar = bars[lo : lo + V.TOGETHER]
            found = V.Found(k, bar.ravel(), tie)
            live = found.bar.reshape(n, windows)

            def score(b, qs):
                inside = slice(first[b], end[b])
                r_low, r_high = _scores(*_interval(qa[qs], angle[inside], angle[inside]), qn[qs], norm[inside], norm[inside])
                meets = np.zeros(r_low.shape, bool)
                for w in range(windows):
                    meets |= (r_high >= live[qs, w][:, None]) & (r_low <= ceiling[qs, w][:, None])
                meets &= own[inside][None] != who[qs][:, None]
                i, j = np.flatnonzero(meets.any(1)), np.flatnonzero(meets.any(0))
                s = np.zeros(r_low.shape, np.int64)
                if len(i):
                    s[np.ix_(i, j)] = V.products(part[qs[i]], x[inside][j])
                return order[inside], s, meets

            V.search(high, low, floor, ceiling, found, score)
            out.append(V.found_table(found, windows, who, ids))
        return pa.concat_tables(out)

    return task


def hard_negatives(
    embeddings: DataFrame, label: str = "label", every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE, references: int = REFERENCES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``every``. ``label``: column (or expression) that holds the class."""
    spark = embeddings.sparkSession
    plain = tb.materialized(V.valid_vectors(embeddings.where(F.expr(label).isNotNull()), F.expr(label).cast("long").alias("label")), "labelled-vectors")
    sample = plain.select("x").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).toArrow()
    refs = fit_references(V.matrix(sample.column("x"), scale), references) if sample.num_rows else np.zeros((0, 0))
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in plain.schema.fields)}, norm double, angles array<float>, near int"
    rows = tb.materialized(plain.mapInArrow(_angles(refs, scale), schema), "angle-index")
    anchors = rows.where(F.col("vec_id") % every == 0)
    liked = tb.materialized(V.search_all(rows, anchors, _search(len(refs), positives, scale, True, 1), positives), "positives")
    # the window of every positive; places of positives that are missing stay null
    by_rank = [F.max(F.when(F.col("rank") == r + 1, F.col("score"))) for r in range(positives)]
    windows = liked.groupBy(F.col("query").alias("row")).agg(F.array(*by_rank).alias("windows"))
    asking = tb.materialized(anchors.join(windows, "row"), "windows")
    hard = V.search_all(rows, asking, _search(len(refs), negatives, scale, False, positives), negatives)
    pairs = liked.select("query", (F.col("rank") - 1).cast("int").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = hard.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(pairs, ["query", "slot"])
    names = anchors.select(F.col("row").alias("query"), F.col("vec_id").alias("anchor_id"))
    return named.join(names, "query").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
