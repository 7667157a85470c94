"""MinHash near-duplicate detection by a chosen-path set similarity join.

Method. A document is its set of distinct word n-gram shingles. Documents of equal sets form a
class at once (one aggregation); class representatives enter ``TREES`` independent
branching trees. On each level a node branches along ``BRANCHES`` minwise hash functions: a
representative goes to the child named by its minwise shingle. Two sets of similarity s stay
together in a child with probability s, so the branching process of a pair has mean offspring
BRANCHES * s; at s = 0.8 and 3 branches a tree loses a pair with probability q = (0.2 + 0.8q)^3 =
0.0083 at most (over any depth), three trees with 6e-7. ``trees_for`` derives the number of trees from the target recall.

Nodes of at most ``NODE`` members are compared exhaustively inside a task, by two-bit minwise sketches of 128
functions whose bar lies 4.5 standard deviations beyond the mean at the threshold. In a first round a node offers its similar
pairs, or, if they are many, one a member, its first similar one; the first pair of each member is confirmed on full shingle sets,
and these are joined into components. A second round offers every similar pair that lies in
different components, so what is skipped cannot change a component: nodes whose pairs are all known are not compared again, and
a node in which such pairs are many (documents that are
similar, but not enough) offers its members instead, and their full sets are compared inside one task by products of
their incidence matrix, at most NODE rows wide, which returns a forest of links. A larger node first tries to link
every member to the node's smallest id. Members confirmed as linked need no comparison with each other;
the node goes on branching only if unlinked members are left, and children without an unlinked
member end. So a group of near copies of any size costs about one link per member, never all pairs. Nodes still
large after ``LEVELS`` levels are finished exactly: their unlinked members meet every member, each two blocks of them in a small
node of its own.

Components come from alternating large-star / small-star rounds of joins.

Candidate pairs are stored before they are confirmed, one for each member in the first round (its smallest similar
partner over all nodes). A bitmap of bounded size names the texts that pairs need to the scan, so no other text is
shuffled; a needed one moves once, and once more for each pair.

A document is a (doc_id, text): rows that repeat a doc_id with another text are documents of their own, each with the component of
its text. Nodes carry the number of a stored class, and a component takes its smallest doc_id at the end.

Defined results: null or empty text, or no word: empty set, linked with nothing, its own component; fewer
words than a shingle: the whole sequence is the one shingle; every row is returned; a null doc_id takes part and its component is the
smallest id it is linked with (null and kept without one). ``keep_first`` leaves one row of each component, the one of smallest
doc_id (of several texts the one of smallest digest, of equal rows any); rows with an empty set all stay.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb

BRANCHES, LEVELS, NODE = 3, 4, 2048
RECALL = 0.999999
SKETCH = 128
DEVIATIONS = 4.5
#: nodes up to this size are compared all at once, larger ones member by member
SMALL = 12
#: a node with more candidate pairs a member in the second round is compared on full sets as a whole
DENSE = 4
#: pairs of a node whose sketches are compared at once
BLOCK_PAIRS = 1 << 15
MAX_BROADCAST_NODES = 200_000

_g = np.random.RandomState(99)
_SKETCH_MUL = _g.randint(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SKETCH_ADD = _g.randint(0, 1 << 32, SKETCH, dtype=np.uint64).astype(np.uint32)
_PATH_MUL = _g.randint(0, 1 << 32, 1024, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_PATH_ADD = _g.randint(0, 1 << 32, 1024, dtype=np.uint64).astype(np.uint32)


def trees_for(recall: float, similarity: float, branches: int = BRANCHES) -> int:
    """Independent trees until a pair at the threshold is missed with probability at most 1 - recall."""
    q = 0.0
    for _ in range(200):
        q = (1 - similarity + similarity * q) ** branches
    return max(1, math.ceil(math.log(1 - recall) / math.log(q)))


def sketch_bar(similarity: float) -> int:
    """Differing two-bit sketch values allowed: equal sets' minima agree, others by chance in one of four."""
    p = (1 - similarity) * 0.75
    return math.ceil(SKETCH * p + DEVIATIONS * math.sqrt(SKETCH * p * (1 - p)))


def shingle_hashes(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): for each row its sorted distinct shingle hashes."""
    low = tb.lowered(data)
    s, e = tb.runs(np.take(tb.WORD_BYTE, low, mode="clip"), off)
    h = tb.run_hashes(low, s, e)
    rows = len(off) - 1
    words = np.diff(np.searchsorted(s, off))
    first = np.concatenate([[0], np.cumsum(words)])
    row = np.repeat(np.arange(rows), words)
    place = np.arange(len(h)) - first[row]
    with np.errstate(over="ignore"):
        x = np.zeros(len(h), np.uint64)
        whole = words[row] < n
        for k in range(n):
            nxt = np.zeros(len(h), np.uint64)
            nxt[: max(len(h) - k, 0)] = h[k:]
            inside = place + k < words[row]
            x = np.where(inside, tb.mix64(x * np.uint64(0x100000001B3) + nxt + np.uint64(k + 1)), x)
    start = np.where(whole, place == 0, place + n <= words[row])
    x, row = x[start], row[start]
    bounds = np.searchsorted(row, np.arange(rows + 1)).tolist()
    for a, b in zip(bounds, bounds[1:]):
        x[a:b].sort()
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
    x, row = x[new], row[new]
    return x, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int64)


def _minwise(x: np.ndarray, first: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """rows x functions minima of random permutations of the 32 high bits (first: starts of non-empty rows)."""
    a = (x >> np.uint64(32)).astype(np.uint32)
    b = x.astype(np.uint32)
    out = np.empty((len(first), len(mul)), np.uint32)
    with np.errstate(over="ignore"):
        for j in range(len(mul)):
            v = a * mul[j]
            v += b ^ add[j]
            v *= np.uint32(0x9E3779B1)
            out[:, j] = np.minimum.reduceat(v, first)
    return out


def _signatures(n: int, trees: int):
    need = trees * BRANCHES * LEVELS

    def run(batches):
        for rows, data, off in tb.text_slices(batches):
            x, o = shingle_hashes(data, off, n)
            size = np.diff(o)
            full = size > 0
            k1, k2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            sketch = np.zeros((4, len(size)), np.uint64)
            coords = [b""] * len(size)
            if full.any():
                first = o[:-1][full]
                with np.errstate(over="ignore"):
                    k1[full] = np.add.reduceat(tb.mix64(x), first)
                    k2[full] = np.add.reduceat(tb.mix64(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
                minima = tb.mix64(_minwise(x, first, _SKETCH_MUL, _SKETCH_ADD).astype(np.uint64))
                for plane, shift in ((0, 17), (2, 29)):
                    bits = (minima >> np.uint64(shift)).astype(np.uint8) & 1
                    sketch[plane : plane + 2, full] = np.packbits(bits, axis=1).view(np.uint64).T
                c = _minwise(x, first, _PATH_MUL[:need], _PATH_ADD[:need])
                for i, r in zip(np.flatnonzero(full), c):
                    coords[i] = r.tobytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("d1"), rows.column("d2"), pa.array(size, pa.int64()), *(pa.array(v.view(np.int64)) for v in (k1, k2, *sketch)), pa.array(coords, pa.binary())],
                ["doc_id", "d1", "d2", "n_shingles", "k1", "k2", *PLANES, "coords"],
            )

    return run


SIGNATURE = "doc_id long, d1 long, d2 long, n_shingles long, k1 long, k2 long, s0 long, s1 long, s2 long, s3 long, coords binary"
PLANES = ("s0", "s1", "s2", "s3")


def _expand(trees: int, level: int):
    """Child nodes of rows (path, tree, rep, n, sketch, u, coords) on a level; the root has all trees."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            c = np.frombuffer(b"".join(x.as_py() for x in b.column("coords")), np.uint32).reshape(b.num_rows, -1)
            path = b.column("path").to_numpy().view(np.uint64)
            tree = b.column("tree").to_numpy()
            row = np.arange(b.num_rows)
            for t in range(trees) if level == 0 else (tree,):
                for j in range(BRANCHES):
                    which = np.broadcast_to(t, b.num_rows).astype(np.int64) * (BRANCHES * LEVELS) + level * BRANCHES + j
                    with np.errstate(over="ignore"):
                        child = tb.mix64(path * np.uint64(0x9E3779B97F4A7C15) + c[row, which].astype(np.uint64) * np.uint64(0x100000001B3) + which.astype(np.uint64))
                    yield pa.RecordBatch.from_pydict(
                        {"path": pa.array(child.view(np.int64)), "tree": pa.array(np.broadcast_to(t, b.num_rows).astype(np.int32))} | {k: b.column(k) for k in ("rep", "n", *PLANES, "u")}
                    )

    return run


def _array(column: pa.Array, name: str) -> np.ndarray:
    """Sketch words as unsigned: the bit count of a negative number is that of its absolute value."""
    x = column.to_numpy(zero_copy_only=False)
    return x.view(np.uint64) if name in PLANES else x


FRONTIER = "path long, tree int, rep long, n long, s0 long, s1 long, s2 long, s3 long, u boolean"


def _compare_nodes(similarity: float, bar: int, across: bool):
    """Rows sorted by (path, rep): pairs (a < b) of similar members of a node. All of them if they are few; else one a member, its
    first similar one, and the node itself to come back to: (null, null, path). ``across`` components: those that lie in
    different ones, or the members of nodes with very many such pairs: (a, null, path)."""

    def similar(c, i, j):
        """Those pairs of rows that are similar: half of the sketch leaves few to look at."""
        some = np.bitwise_count((c["s0"][i] ^ c["s0"][j]) | (c["s2"][i] ^ c["s2"][j])) <= bar
        i, j = i[some], j[some]
        ok = np.bitwise_count((c["s0"][i] ^ c["s0"][j]) | (c["s2"][i] ^ c["s2"][j])).astype(np.int16)
        ok = ok + np.bitwise_count((c["s1"][i] ^ c["s1"][j]) | (c["s3"][i] ^ c["s3"][j])) <= bar
        a, b = c["n"][i], c["n"][j]
        ok &= np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9
        ok &= (c["u"][i] | c["u"][j]) & (c["rep"][i] != c["rep"][j])
        if across:
            ok &= c["comp"][i] != c["comp"][j]
        return i[ok], j[ok]

    def blocks(c, a, b):
        """Similar pairs of the rows a to b, block by block of the later member; in a block by later member, then earlier one."""
        step = max(1, BLOCK_PAIRS // (b - a))
        for lo in range(a, b, step):
            hi = min(lo + step, b)
            x = c["s0"][lo:hi, None] ^ c["s0"][a:hi]
            x |= c["s2"][lo:hi, None] ^ c["s2"][a:hi]
            at = np.flatnonzero(np.bitwise_count(x) <= bar)
            j, i = lo + at // (hi - a), a + at % (hi - a)
            yield similar(c, i[i < j], j[i < j])

    def pairs(c: dict):
        path = c["path"]
        cut = np.flatnonzero(path[1:] != path[:-1]) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(path)]])
        end = np.repeat(hi, hi - lo)
        row = np.arange(len(path))
        small = end - np.repeat(lo, hi - lo) <= SMALL
        found, members, again = [], [row[:0]], [row[:0]]
        for d in range(1, SMALL):
            i = row[small & (row + d < end)]
            if not len(i):
                break
            found.append(similar(c, i, i + d))
        wide = hi - lo > SMALL
        for a, b in zip(lo[wide].tolist(), hi[wide].tolist()):
            if across and (c["comp"][a:b] == c["comp"][a]).all():
                continue
            own, firsts, offered, met = [], [], 0, np.zeros(b - a, bool)
            for i, j in blocks(c, a, b):
                offered += len(i)
                if offered <= DENSE * (b - a):
                    own.append((i, j))
                met[i - a] = met[j - a] = True
                if not across:
                    _, k = np.unique(j, return_index=True)
                    firsts.append((i[k], j[k]))
            if offered <= DENSE * (b - a):
                found += own
            elif across:
                members.append(a + np.flatnonzero(met))
            else:
                found += firsts
                again.append(row[a : a + 1])
        i = np.concatenate([x for x, _ in found]) if found else row[:0]
        j = np.concatenate([y for _, y in found]) if found else row[:0]
        x, y = c["rep"][i], c["rep"][j]
        both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
        members, again = np.concatenate(members), np.concatenate(again)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(both[:, 0]), pa.array(c["rep"][members]), pa.nulls(len(again), pa.int64())]),
                pa.concat_arrays([pa.array(both[:, 1]), pa.nulls(len(members) + len(again), pa.int64())]),
                pa.concat_arrays([pa.nulls(len(both), pa.int64()), pa.array(path[np.concatenate([members, again])])]),
            ],
            ["a", "b", "path"],
        )

    names = ("path", "rep", "n", *PLANES, "u", *(("comp",) if across else ()))

    def run(batches):
        held: list[dict] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append({k: _array(batch.column(k), k) for k in names})
            rows += batch.num_rows
            if held[0]["path"][0] == held[-1]["path"][-1]:
                continue  # one node so far
            c = {k: np.concatenate([h[k] for h in held]) for k in names}
            last = int(np.flatnonzero(c["path"] != c["path"][-1])[-1]) + 1
            yield pairs({k: v[:last] for k, v in c.items()})
            held = [{k: v[last:] for k, v in c.items()}]
        if held:
            yield pairs({k: np.concatenate([h[k] for h in held]) for k in names})

    return run


def _confirm(n: int, percent: int):
    """Rows (a, b, text_a, text_b) -> a, b of those whose shingle sets are similar enough."""

    def sets(texts: pa.Array) -> list[np.ndarray]:
        x, o = shingle_hashes(*tb.buffers(texts), n)
        return [x[i:j] for i, j in zip(o[:-1], o[1:])]

    def run(batches):
        for batch in batches:
            a, texts = batch.column("a").to_numpy(), [batch.column(k) for k in ("text_a", "text_b")]
            keep = []
            for lo, hi in tb.slices(sum(tb.buffers(t)[1] for t in texts)):
                # neighbours of one text share its set
                new = np.ones(hi - lo, bool)
                new[1:] = a[lo + 1 : hi] != a[lo : hi - 1]
                of_a = sets(texts[0].slice(lo, hi - lo).filter(pa.array(new)))
                for x, y in zip((of_a[k] for k in np.cumsum(new) - 1), sets(texts[1].slice(lo, hi - lo))):
                    inter = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(inter > 0 and 100 * inter >= percent * (len(x) + len(y) - inter))
            m = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(m), batch.column("b").filter(m)], ["a", "b"])
        tb.give_back()

    return run


def _compare_sets(n: int, percent: int):
    """A node's members with texts: the links on full sets that join its components, one a member at most (a forest:
    further links would join what is joined)."""

    def run(key, table):
        rep, comp = table.column("rep").to_numpy(), table.column("comp").to_numpy()
        x, o = shingle_hashes(*tb.buffers(pa.concat_arrays(table.column("text").chunks)), n)
        size = np.diff(o)
        _, column, df = np.unique(x, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(rep)), size)
        shared = df[column] > 1
        _, column = np.unique(column[shared], return_inverse=True)
        row = row[shared]
        inter = np.zeros((len(rep), len(rep)), np.float32)
        width = 2048
        block = column // width
        for k in range(int(block.max()) + 1 if len(block) else 0):
            own = block == k
            m = np.zeros((len(rep), width), np.float32)
            m[row[own], column[own] - k * width] = 1
            inter += m @ m.T
        near = (inter > 0) & (100 * inter >= percent * (size[:, None] + size[None] - inter))
        same = comp[:, None] == comp[None]
        near &= ~same
        links = []
        left = near.any(1)
        while left.any():
            reached, queue = np.zeros(len(rep), bool), [int(left.argmax())]
            reached[queue[0]] = True
            while queue:
                u = queue.pop()
                mates = np.flatnonzero(same[u] & ~reached)
                others = np.flatnonzero(near[u] & ~reached)
                reached[mates] = reached[others] = True
                links += [(u, v) for v in others]
                queue += [*mates.tolist(), *others.tolist()]
            left &= ~reached
        i, j = (np.array(x, np.int64) for x in (zip(*links) if links else ((), ())))
        return pa.table({"a": pa.array(np.minimum(rep[i], rep[j]), pa.int64()), "b": pa.array(np.maximum(rep[i], rep[j]), pa.int64())})

    return run


KEY = ("id", "d1", "d2")


def one_text(texts: DataFrame, reps: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, d1, d2, text of the documents that stand for the classes ``reps``, each once; rep, id, d1, d2 of those classes).

    A filter of their keys goes to the scan of the texts, so others are not shuffled, however many classes are named."""
    named = tb.materialized(names.join(reps, "rep", "left_semi"), "named", narrow=True)
    some, _ = tb.split_by_filter(texts, tb.key_filter(named, *KEY), *KEY)
    return some.groupBy(*KEY).agg(F.first("text").alias("text")), named


def confirm(pairs: DataFrame, texts: DataFrame, names: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes confirmed on the full sets. ``texts``: id, d1, d2, text of all rows; ``names``: rep and the
    key (id, d1, d2) of the document that stands for each class. A named text moves once to its key, and once for each pair to the
    partner's."""
    pairs = tb.materialized(pairs.select("a", "b").distinct(), "pairs", narrow=True)
    reps = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    found, named = one_text(texts, reps, names)
    key = lambda x: {"rep": x} | {k: f"{k}_{x}" for k in KEY}
    keyed = pairs.join(named.withColumnsRenamed(key("a")), "a").join(named.withColumnsRenamed(key("b")), "b")
    for x in ("b", "a"):
        side = found.withColumnsRenamed({k: f"{k}_{x}" for k in KEY} | {"text": f"text_{x}"})
        keyed = keyed.join(side, [f"{k}_{x}" for k in KEY]).drop(*[f"{k}_{x}" for k in KEY])
    return keyed.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(n, percent), "a long, b long")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, component (smallest id reachable) of every id in ``links`` (a, b).

    Alternates large-star and small-star rounds until nothing changes; every round is written to the
    shared folder. Each round is two group minima and joins, so a hub's links are never gathered in one task."""
    edges = links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).where("x > y").distinct()
    edges = tb.materialized(edges, name, narrow=True)
    if edges.isEmpty():
        return edges.select(F.col("x").alias("node"), F.col("y").alias("component"))
    seen = None
    while True:
        both = edges.union(edges.select("y", "x"))
        low = both.groupBy(F.col("x").alias("k")).agg(F.min("y").alias("m")).select("k", F.least("m", "k").alias("m"))
        large = both.join(low, both["x"] == low["k"]).where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        low2 = large.groupBy(F.col("x").alias("k")).agg(F.min("y").alias("m"))
        j = large.join(low2, large["x"] == low2["k"])
        small = j.where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y")).union(low2.select(F.col("k").alias("x"), F.col("m").alias("y")))
        edges = tb.materialized(small.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), name, narrow=True)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("x").alias("node"), F.col("y").alias("component"))
        seen = now


def _nodes(rows: DataFrame, similarity: float, bar: int, across: bool) -> DataFrame:
    """Candidate pairs of the small nodes in ``rows``."""
    tasks = tb.shuffle_tasks(rows.sparkSession)
    sorted_rows = rows.repartition(tasks, "path").sortWithinPartitions("path", "rep")
    return sorted_rows.mapInArrow(_compare_nodes(similarity, bar, across), "a long, b long, path long").distinct()


def _blocks(frontier: DataFrame) -> DataFrame:
    """Large nodes as small ones: unlinked and linked members are dealt into blocks, and each two blocks, of which one is unlinked,
    make a node. So every pair that is to be compared meets in one, and no task holds a large node."""
    half = max(1, NODE * 3 // 8)  # blocks are dealt by a hash: two of them stay below NODE
    number = lambda u: F.ceil(F.count_if(u) / half).alias
    numbers = frontier.groupBy("path").agg(number(F.col("u"))("open"), number(~F.col("u"))("linked"))
    numbers = tb.checked_broadcast(tb.materialized(numbers, "blocks", narrow=True), MAX_BROADCAST_NODES)
    own = F.when(F.col("u"), F.pmod(F.xxhash64("rep"), F.col("open"))).otherwise(F.col("open") + F.pmod(F.xxhash64("rep"), F.col("linked")))
    others = F.sequence(F.lit(0).cast("long"), F.col("open") + F.when(F.col("u"), F.col("linked")).otherwise(0) - 1)
    met = frontier.join(numbers, "path").withColumn("own", own).withColumn("other", F.explode(others)).where("own <> other")
    return met.withColumn("path", F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other"))).select(frontier.columns)


def links(classes: DataFrame, texts: DataFrame, names: DataFrame, n: int, percent: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """Links among class representatives that decide the components: (node, component) of a first round of
    confirmed links, and the confirmed links (a, b) of the second round between those components.

    ``classes``: doc_id (the class's number), n_shingles, sketch and coords of each; ``texts`` and ``names`` as in ``confirm``."""
    similarity = percent / 100
    bar = sketch_bar(similarity)
    near = lambda x, q: (
        f"bit_count(({x}s0 ^ {q}0) | ({x}s2 ^ {q}2)) + bit_count(({x}s1 ^ {q}1) | ({x}s3 ^ {q}3)) <= {bar} "
        f"and least({x}n, {q}n) >= {similarity!r} * greatest({x}n, {q}n) - 1e-9"
    )
    reps = classes.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), *PLANES)
    coords = classes.select(F.col("doc_id").alias("rep"), "coords")
    grown = classes.select(F.lit(0).cast("long").alias("path"), F.lit(0).alias("tree"), F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), *PLANES, F.lit(True).alias("u"), "coords")
    small, confirmed, frontier = [], [], None
    for level in range(LEVELS):
        frontier = tb.materialized(grown.mapInArrow(_expand(trees, level), FRONTIER), "frontier")
        big = tb.materialized(frontier.groupBy("path").agg(F.count("*").alias("c"), F.max("u").alias("open"), F.min("rep").alias("p")).where(F.col("c") > NODE), "large-nodes", narrow=True)
        paths = tb.checked_broadcast(big.select("path"), MAX_BROADCAST_NODES)
        small.append(frontier.join(paths, "path", "left_anti"))
        pivots = big.where("open").select("path", "p").join(reps.select(F.col("rep").alias("p"), F.col("n").alias("pn"), *[F.col(x).alias(f"p{x[1]}") for x in PLANES]), "p")
        pivots = tb.materialized(pivots, "pivots")
        if pivots.isEmpty():
            frontier = None
            break
        large = frontier.join(tb.checked_broadcast(pivots, MAX_BROADCAST_NODES), "path")
        stars = large.where("rep <> p").where(near("", "p")).select(F.col("p").alias("a"), F.col("rep").alias("b")).distinct()
        linked = tb.materialized(confirm(stars, texts, names, n, percent), "stars")
        confirmed.append(linked)
        done = linked.select(F.col("a").alias("p"), F.col("b").alias("rep"), F.lit(False).alias("open"))
        state = large.join(done, ["p", "rep"], "left").withColumn("u", F.coalesce("open", F.col("rep") != F.col("p")))
        state = tb.materialized(state.select("path", "tree", "rep", "n", *PLANES, "u"), "state")
        # nodes whose members are all linked to the pivot are finished
        going = tb.checked_broadcast(state.where("u").select("path").distinct(), MAX_BROADCAST_NODES)
        frontier = state.join(going, "path", "left_semi")
        grown = frontier.join(coords, "rep")
    if frontier is not None:
        small.append(_blocks(frontier))
    rows = _all(small)
    near_pairs = tb.materialized(_nodes(rows, similarity, bar, across=False), "first-candidates", narrow=True)
    known_pairs = near_pairs.where("path is null").select("a", "b")
    # the smallest partner of every member, over all nodes
    first = known_pairs.groupBy("b").agg(F.min("a").alias("a"))
    confirmed.append(tb.materialized(confirm(first, texts, names, n, percent), "first-links"))
    so_far = tb.materialized(components(_all(confirmed)), "first-components")
    # nodes whose pairs are all known need no second look
    again = tb.checked_broadcast(near_pairs.where("path is not null").select("path"), MAX_BROADCAST_NODES)
    known = rows.join(again, "path", "left_semi").join(so_far.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    found = tb.materialized(_nodes(known, similarity, bar, across=True), "second-candidates")
    second_pairs = between(known_pairs, so_far).where("ca <> cb").select("a", "b").unionByName(found.where("path is null").select("a", "b"))
    pairs = confirm(second_pairs, texts, names, n, percent)
    members = found.where("path is not null").select("path", F.col("a").alias("rep"))
    members = members.join(so_far.withColumnRenamed("node", "rep"), "rep", "left").select("path", "rep", F.coalesce("component", "rep").alias("comp"))
    found_texts, named = one_text(texts, members.select("rep").distinct(), names)
    dense = members.join(named.join(found_texts, list(KEY)).select("rep", "text"), "rep").groupBy("path").applyInArrow(_compare_sets(n, percent), "a long, b long").distinct()
    second = pairs.unionByName(dense)
    return so_far, tb.materialized(second, "second-links")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def between(pairs: DataFrame, so_far: DataFrame) -> DataFrame:
    """Pairs (a, b) with the components ca, cb of both sides."""
    side = lambda k: so_far.select(F.col("node").alias(k), F.col("component").alias(f"c{k}"))
    return pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))


def component_of(so_far: DataFrame, more: DataFrame) -> DataFrame:
    """node, component over both rounds: the second one's links are joined as links of first components."""
    upper = tb.materialized(components(between(more, so_far).select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "second-components")
    moved = so_far.join(upper.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return moved.unionByName(upper.join(moved, "node", "left_anti"))


NO_ID = -(1 << 63)


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, its key (null ids as one number) with the two halves of the text's digest, and the text."""
    text = F.coalesce("text", F.lit(""))
    return tb.id_text(docs).select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2"), "text")


def _components(docs: DataFrame, shingle: int, percent: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, d1, d2, n_shingles, k1, k2 of every row; k1, k2, component, component_id of every class of equal sets)."""
    trees = trees_for(recall, percent / 100)
    texts = _documents(docs)
    signed = tb.materialized(texts.mapInArrow(_signatures(shingle, trees), SIGNATURE), "signatures")
    known = signed.where("n_shingles > 0")
    # one document stands for each distinct set: any of its texts has that set
    key = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "d1", "d2")
    classes = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.min(key).alias("key"), F.first(F.struct("n_shingles", *PLANES, "coords")).alias("s"))
    classes = tb.materialized(classes.select(F.monotonically_increasing_id().alias("doc_id"), "k1", "k2", "least", "key.*", "s.*"), "classes")
    names = classes.select(F.col("doc_id").alias("rep"), *KEY)
    comp = component_of(*links(classes, texts.select(*KEY, "text"), names, shingle, percent, trees))
    of_class = classes.select("k1", "k2", "least", F.col("doc_id").alias("node")).join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_class = tb.materialized(of_class.select("k1", "k2", "least", "component"), "class-components", narrow=True)
    smallest = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    return signed.drop(*PLANES, "coords"), of_class.join(smallest, "component").select("k1", "k2", "component", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    signed, comp = _components(docs, shingle, percent, recall)
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        signed.join(comp, ["k1", "k2"], "left")
        .select("doc_id", "n_shingles", alone.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    )


def keep_first(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (all columns) that stand for their component."""
    signed, comp = _components(docs, shingle, percent, RECALL)
    rows = signed.where("n_shingles > 0").join(comp, ["k1", "k2"]).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("doc_id").isNull().alias("unnamed"), "d1", "d2", "component")
    documents = rows.groupBy(*KEY, "unnamed").agg(F.first("component").alias("component"), F.count("*").alias("copies"))
    documents = tb.materialized(documents, "documents", narrow=True)
    first = documents.groupBy("component").agg(F.min(F.struct("unnamed", *KEY)).alias("f")).select("f.*", F.lit(True).alias("first"))
    judged = documents.join(first, ["unnamed", *KEY], "left").where("first is null or copies > 1")
    # documents that go, and those that stay but occur more than once
    marks = tb.materialized(judged.select(*KEY, F.col("first").isNull().alias("gone")), "marks", narrow=True)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2"))
    some, untouched = tb.split_by_filter(held, tb.key_filter(marks, *KEY), *KEY)
    met = some.join(marks, list(KEY), "left")
    again = met.where("not gone").groupBy(*KEY).agg(F.first("row").alias("row"))
    return _all([x.select("row.*") for x in (untouched, met.where("gone is null"), again)])
