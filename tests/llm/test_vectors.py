"""The vector operators against brute force on tables that hold the awkward cases."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import clustering, hard_negatives, topk
from ledgerline.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string, row string"


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def whole(v, scale):
    return [math.floor(scale * float(np.float32(c))) for c in v]


def dot(a, b):
    return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))


def by_score(pairs):
    """(score, id) best first: highest score, smallest id, null last."""
    return sorted(pairs, key=lambda p: (-p[0], p[1] is None, p[1] or 0))


def vectors(seed=5, n=900, d=8, wide=False):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = centre[rng.randrange(5)] if rng.random() < 0.7 else [0.0] * d
        rows.append((i, [round(x + rng.gauss(0, 0.2), 2) for x in c], rng.choice([0, 1, 1, 1, 2, None]), 0.5, "r", "x"))
    same = [0.25] * d
    rows += [(1000 + i, same, i % 3, None, None, None) for i in range(60)]  # ties
    rows += [(200, same, 1, None, None, None), (200, same, 1, None, None, None), (300, [1.0] * d, 2, None, None, None)]  # repeated ids
    rows += [(None, same, 1, None, None, None), (-100, same, 1, None, None, None), (None, None, None, None, None, None)]
    rows += [(5000, None, 1, None, None, None), (5100, [None] * d, 1, None, None, None), (5200, [float("nan")] * d, 1, None, None, None), (5300, [float("inf")] + same[1:], 0, None, None, None)]
    rows += [(5400, [], 1, None, None, None), (5500, [0.0] * d, 0, None, None, None), (5600, [1.0, 2.0], 1, None, None, None), (5700, same + [3.0], 1, None, None, None)]
    if wide:
        rows += [(5800, [1e30] * d, 1, None, None, None), (5801, [-1e30] * d, 2, None, None, None), (5802, [3e8] + same[1:], 0, None, None, None)]
    rng.shuffle(rows)
    return rows


def brute_top(rows, every=100, k=10, scale=1024):
    x = [(r[0], whole(r[1], scale)) for r in rows if usable(r[1])]
    out = []
    for i, (q, a) in enumerate(x):
        if q is None or q % every:
            continue
        best = by_score([(dot(a, b), c) for j, (c, b) in enumerate(x) if j != i])[:k]
        out += [(q, r + 1, c, s) for r, (s, c) in enumerate(best)]
    return sorted(out, key=repr)


def brute_hard(rows, every=100, scale=256):
    x = [(r[0], whole(r[1], scale), (r[2] + 1) % 10 if r[0] is not None and r[0] % 7 == 0 else r[2]) for r in rows if usable(r[1]) and r[2] is not None]
    out = []
    for i, (q, a, la) in enumerate(x):
        if q is None or q % every:
            continue
        scored = [(dot(a, b), c, lb) for j, (c, b, lb) in enumerate(x) if j != i]
        for p, pid in by_score([(s, c) for s, c, lb in scored if lb == la])[:5]:
            negatives = by_score([(s, c) for s, c, lb in scored if lb != la and 80 * p <= 100 * s <= 100 * p])[:5]
            out += [(q, pid, r + 1, c, p, s) for r, (s, c) in enumerate(negatives)]
    return sorted(out, key=repr)


def brute_clusters(rows, k=16, rounds=3, size=64, scale=64):
    x = [(r[0], whole(r[1], scale)) for r in rows if usable(r[1]) and len(r[1]) == size]
    order = sorted(range(len(x)), key=lambda i: (x[i][0] is None, hashlib.sha256(f"1:{x[i][0]}".encode()).hexdigest() if x[i][0] is not None else "", x[i][1]))
    centroids = [x[i][1] for i in order[:k]]

    def assign():
        out = []
        for _, v in x:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(min(d), 2**63 - 1)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [x[i][1] for i, (j, _) in enumerate(own) if j == c]
            if members:
                centroids[c] = [sum(col) // len(members) for col in zip(*members)]
    own = assign()
    cut = lambda v: min(v, 2**63 - 1)
    per = {c: cut(sum(d for j, d in own if j == c)) for c, _ in own}
    return sorted(
        [(i, c, d, per[c], cut(sum(per.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(x, own)], key=repr
    )


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SHIFTED = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


@pytest.mark.parametrize("wide", [False, True])
def test_top_k(spark, wide, monkeypatch):
    monkeypatch.setattr(V, "LEAST_ROWS", 150)
    rows = vectors(wide=wide)
    df = topk.top_k(frame(spark, rows), block=16)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    assert got(df) == brute_top(rows)


@pytest.mark.parametrize("wide", [False, True])
def test_hard_negatives(spark, wide, monkeypatch):
    monkeypatch.setattr(V, "LEAST_ROWS", 150)
    rows = vectors(seed=6, wide=wide)
    want = brute_hard(rows, every=50)
    assert len(want) > 50 and any(r[5] < r[4] for r in want)
    assert got(hard_negatives.hard_negatives(frame(spark, rows), SHIFTED, every=50)) == want


def test_several_chunks_of_queries(spark, monkeypatch):
    """Segments and chunks far smaller than a production one: every pair of them meets once."""
    monkeypatch.setattr(V, "SEGMENT", 600)
    monkeypatch.setattr(V, "LEAST_ROWS", 100)
    rows = vectors(seed=8, n=300)
    assert got(topk.top_k(frame(spark, rows), every=2, k=3)) == brute_top(rows, every=2, k=3)


@pytest.mark.parametrize("wide", [False, True])
def test_clusters(spark, wide):
    rows = vectors(seed=9, n=400, wide=wide)
    assert got(clustering.cluster(frame(spark, rows), k=6, size=8)) == brute_clusters(rows, k=6, size=8)


def test_clusters_with_fewer_vectors_than_centroids_and_one_value(spark):
    rows = [(i, [0.5] * 4, 1, None, None, None) for i in range(5)]
    assert got(clustering.cluster(frame(spark, rows), k=16, size=4)) == brute_clusters(rows, k=16, size=4)


def test_empty_tables_and_no_queries(spark):
    none = frame(spark, [])
    assert got(topk.top_k(none)) == [] and got(hard_negatives.hard_negatives(none)) == [] and got(clustering.cluster(none)) == []
    only = frame(spark, [(7, [1.0, 2.0], 1, None, None, None), (8, None, 1, None, None, None)])
    assert got(topk.top_k(only)) == [] and got(hard_negatives.hard_negatives(only)) == []
    alone = frame(spark, [(100, [1.0, 2.0], 1, None, None, None)])
    assert got(topk.top_k(alone)) == [] and got(hard_negatives.hard_negatives(alone)) == []


def test_result_does_not_depend_on_partitions(spark):
    rows = vectors(seed=10, n=500)
    for run in (topk.top_k, hard_negatives.hard_negatives, lambda d: clustering.cluster(d, k=5, size=8)):
        assert got(run(frame(spark, rows, 1))) == got(run(frame(spark, rows, 7)))


def clustered(n=2000, d=16, k=10, noise=0.02, seed=3):
    rng = np.random.RandomState(seed)
    x = rng.randn(k, d)[rng.randint(0, k, n)] + noise * rng.randn(n, d)
    return np.floor(1024 * x)


def test_blocks_below_the_bar_are_not_scored(monkeypatch):
    x = clustered()
    calls = []
    real = V.products
    monkeypatch.setattr(V, "products", lambda a, b: calls.append(len(a) * len(b)) or real(a, b))
    lists = pa.array([list(r / 1024) for r in x], pa.list_(pa.float64()))
    rows = pa.table({"row": np.arange(len(x)), "vec_id": np.arange(len(x)), "x": lists})
    asked = rows.slice(0, 50).append_column("seed", pa.nulls(50, pa.list_(pa.int64())))
    out = topk._search(10, 1024, 32)(rows, asked)
    assert sum(calls) < 0.3 * 50 * len(x)
    s = (x[:50] @ x.T).astype(np.int64)
    s[np.arange(50), np.arange(50)] = V._LONG.min
    assert sorted(out.column("score").to_pylist()) == sorted(np.sort(s, axis=1)[:, -10:].ravel().tolist())


def test_angle_bounds_hold_and_filter():
    x = clustered()
    refs = hard_negatives.fit_references(x)
    unit, norm = hard_negatives._unit(x)
    angle = np.arccos(np.clip(unit @ refs.T, -1, 1)).astype(np.float32).astype(np.float64)
    low, high = hard_negatives._scores(*hard_negatives._interval(angle[:80], angle, angle), norm[:80], norm, norm)
    s = x[:80] @ x.T
    assert (low <= s).all() and (s <= high).all()
    assert (high < 0.8 * (norm[:80] ** 2)[:, None]).mean() > 0.5
    first = np.arange(0, len(x), 40)
    lo, hi = np.minimum.reduceat(angle, first), np.maximum.reduceat(angle, first)
    b_low, b_high = hard_negatives._scores(*hard_negatives._interval(angle[:80], lo, hi), norm[:80], np.minimum.reduceat(norm, first), np.maximum.reduceat(norm, first))
    assert (np.repeat(b_low, 40, 1) <= s).all() and (s <= np.repeat(b_high, 40, 1)).all()


def test_ns_bounds_leave_most_distances_out(spark):
    """On separated clusters few distances are computed after the first round, and bounds never exceed what they bound."""
    x = clustered(n=3000, d=8, k=6) / 1024
    rows = [(i, [float(v) for v in r], 0, None, None, None) for i, r in enumerate(x)]
    state, centroids = clustering.assignments(frame(spark, rows), k=6, size=8)
    work = state.selectExpr("avg(computed)").first()[0]
    assert work < 0.5 * 6
    now = np.array(centroids, float)
    for r in state.limit(200).collect():
        v = np.array(whole(r.x, 64), float)
        d = np.sqrt(((now - v) ** 2).sum(1))
        low = np.frombuffer(bytes(r.low), np.float32)
        seen = np.frombuffer(bytes(r.seen), np.uint16)
        for c in range(6):
            if seen[c] == clustering.ROUNDS:
                assert abs(low[c] - d[c]) <= 1e-4 * (1 + d[c])


def test_norm_of_the_sum_is_tighter_than_the_sum_of_norms():
    history = [np.zeros((1, 2)), np.array([[3.0, 0.0]]), np.array([[0.0, 0.0]])]
    assert clustering._gap(history[2], history[0])[0] == 0
    assert sum(clustering._gap(b, a)[0] for a, b in zip(history, history[1:])) >= 6
