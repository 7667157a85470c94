"""Benchmark decontamination over a distributed positional inverted index.

Method. Documents are cut into segments of about ``tb.SLICE_BYTES`` of text (whole documents; one
longer text is a segment of its own). A segment's index holds, for every word of its texts, the
sorted positions of that word in the segment (documents are one empty position apart, so no
phrase crosses them), and a directory of its documents. The index covers all words of all documents and is
written as a Parquet table. A query window (10 consecutive words of a benchmark item; all words
of a shorter one) starts from the posting list of its rarest word in the segment; every
further list, from rare to frequent, is intersected at its offset. What is left are the exact phrase matches.
Proximity matches are windows all of whose words lie within ``SLOP`` words of the rarest one, in any order.

Spark cuts the benchmark into windows, reduces them to different ones, and groups windows that the same items
hold (told by the number of items and 128 bits of their hashes), so that an item's windows found in a document are one row. Windows go to the
tasks in blocks of about ``BLOCK_WINDOWS``, each with its group's number and without items or text: the only part of the benchmark
that the driver holds at a time. Each block passes over the index once, and its
matches are stored before the next. Groups become items in a join afterwards. Words are compared by 64-bit hashes.

Defined results: null or empty texts have no words and no hits; items without words have no window; a null item_id counts
as the empty string; rows that repeat an item_id count as one item; rows that repeat a doc_id are judged each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb

WINDOW = 10
SLOP = 15
#: query windows of a pass over the index, of WINDOW numbers each
BLOCK_WINDOWS = 1 << 16

#: bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` words
WORD_BYTE = tb.lookup(256, bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]), invert=True)

INDEX = "segment long, doc_ids binary, nulls binary, first binary, n_words binary, terms binary, counts binary, positions binary, span long"


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, row of each)."""
    low = tb.lowered(data)
    s, e = tb.runs(WORD_BYTE[low], off)
    return tb.run_hashes(low, s, e), tb.row_of(s, off)


def _build(batches):
    seq = 0
    part = TaskContext.get().partitionId()
    for rows, data, off in tb.text_slices(batches):
        h, row = words(data, off)
        n = np.bincount(row, minlength=rows.num_rows)
        first = np.concatenate([[0], np.cumsum(n[:-1] + 1)]) if len(n) else np.zeros(0, np.int64)
        pos = (np.arange(len(h)) + row).astype(np.int32)
        order = np.argsort(h, kind="stable")
        h, pos = h[order], pos[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(new)
        ids = rows.column("doc_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_pydict(
            {
                "segment": pa.array([(part << 32) + seq], pa.int64()),
                "doc_ids": [ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()],
                "nulls": [(~known).tobytes()],
                "first": [first.astype(np.int32).tobytes()],
                "n_words": [n.astype(np.int32).tobytes()],
                "terms": [h[at].tobytes()],
                "counts": [np.diff(np.append(at, len(h))).astype(np.int32).tobytes()],
                "positions": [_pack(pos, new)],
                "span": pa.array([int(first[-1] + n[-1]) if len(n) else 0], pa.int64()),
            }
        )
        seq += 1


def _pack(pos: np.ndarray, new: np.ndarray) -> bytes:
    """Positions as gaps within each posting list (the first of a list from 0), in 7-bit groups."""
    gap = pos.astype(np.int64)
    inner = np.flatnonzero(~new)
    gap[inner] = pos[inner].astype(np.int64) - pos[inner - 1]
    size = 1 + (gap >= 1 << 7).astype(np.int64) + (gap >= 1 << 14) + (gap >= 1 << 21) + (gap >= 1 << 28)
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    out = np.zeros(off[-1], np.uint8)
    for k in range(5):
        has = size > k
        if not has.any():
            break
        out[off[:-1][has] + k] = ((gap[has] >> (7 * k)) & 0x7F) | np.where(size[has] > k + 1, 0x80, 0)
    return out.tobytes()


def _unpack(raw: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(raw):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(raw < 0x80)
    first = np.concatenate([[0], last[:-1] + 1])
    gap = np.zeros(len(last), np.int64)
    for k in range(5):
        has = first + k <= last
        if not has.any():
            break
        gap[has] |= (raw[first[has] + k].astype(np.int64) & 0x7F) << (7 * k)
    total = np.cumsum(gap)
    start = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    return total - np.repeat(total[start] - gap[start], counts)


def build_index(docs: DataFrame) -> DataFrame:
    """The index table of all documents (written once below the shared folder)."""
    return tb.materialized(tb.id_text(docs).mapInArrow(_build, INDEX), "positional-index")


def _cut(batches):
    for rows, data, off in tb.text_slices(batches):
        h, row = words(data, off)
        n = np.bincount(row, minlength=rows.num_rows)
        count = np.where(n > 0, np.maximum(1, n - WINDOW + 1), 0)
        item = np.repeat(np.arange(rows.num_rows), count)
        start = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(np.cumsum(n) - n, count)
        length = np.minimum(n, WINDOW)[item]
        for lo in range(0, len(item), BLOCK_WINDOWS):
            part = slice(lo, lo + BLOCK_WINDOWS)
            o = np.concatenate([[0], np.cumsum(length[part])]).astype(np.int64)
            terms = h[np.repeat(start[part] - o[:-1], length[part]) + np.arange(o[-1])].astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(terms))
            yield pa.RecordBatch.from_arrays([rows.column("item").take(pa.array(item[part])), lists], ["item", "terms"])


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terms, group) of the different windows, and (group, item)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")).distinct()
    owned = tb.materialized(items.mapInArrow(_cut, "item string, terms array<long>").distinct(), "benchmark-windows", narrow=True)
    owners = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("item")).alias("h"), F.bit_xor(F.xxhash64(F.lit(1), "item")).alias("g")]
    windows = tb.materialized(owned.groupBy("terms").agg(*owners).withColumn("window", F.monotonically_increasing_id()), "benchmark-owners", narrow=True)
    groups = windows.groupBy("n", "h", "g").agg(F.min("window").alias("group"))
    grouped = tb.materialized(windows.join(groups, ["n", "h", "g"]).select("window", "terms", "group"), "benchmark-groups", narrow=True)
    return grouped.select("terms", "group"), grouped.where("window = group").join(owned, "terms").select("group", "item")


class Windows:
    """Query windows of a block."""

    def __init__(self, terms: pa.Array, group: np.ndarray):
        off = terms.offsets.to_numpy().astype(np.int64)
        h = terms.values.to_numpy().view(np.uint64)[off[0] : off[-1]]
        self.length, self.group = np.diff(off), group
        self.terms, place = np.unique(h, return_inverse=True)
        self.term = np.full((len(group), WINDOW), -1, np.int64)
        self.term[np.arange(WINDOW) < self.length[:, None]] = place


def _lists(row: dict, terms: np.ndarray):
    """Posting lists of the query terms in a segment: count of each, and sorted keys (term, position)."""
    have = np.frombuffer(row["terms"], np.uint64)
    counts = np.frombuffer(row["counts"], np.int32).astype(np.int64)
    at = np.searchsorted(have, terms)
    hit = at < len(have)
    hit[hit] = have[at[hit]] == terms[hit]
    positions = _unpack(np.frombuffer(row["positions"], np.uint8), counts)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = np.where(hit, counts[np.minimum(at, len(counts) - 1)] if len(counts) else 0, 0)
    own = np.flatnonzero(n)
    start = first[at[own]]
    total = np.concatenate([[0], np.cumsum(n[own])])
    pick = np.repeat(start - total[:-1], n[own]) + np.arange(total[-1])
    stride = row["span"] + 2 * (WINDOW + SLOP) + 2
    return n, np.repeat(own, n[own]) * stride + positions[pick], stride


def matches(row: dict, q: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window, start) of the exact matches in a segment, (window, position) of the proximity matches."""
    n, keys, stride = _lists(row, q.terms)
    count = np.where(q.term >= 0, n[q.term], np.iinfo(np.int64).max)
    win = np.flatnonzero(count.min(axis=1) > 0) if len(count) else np.zeros(0, np.int64)
    order = np.argsort(count[win], axis=1, kind="stable")
    rare = order[:, 0] if len(win) else np.zeros(0, np.int64)
    term = q.term[win, rare]
    lo = np.searchsorted(keys, term * stride)
    size = n[term]
    total = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    at = keys[np.repeat(lo - total[:-1], size) + np.arange(total[-1])] % stride
    w = np.repeat(np.arange(len(win)), size)
    start = at - rare[w]
    w2, near = w, at
    w, start = w[start >= 0], start[start >= 0]
    last = np.frombuffer(row["first"], np.int32).astype(np.int64)
    words_of = np.frombuffer(row["n_words"], np.int32).astype(np.int64)
    doc = np.searchsorted(last, near, "right") - 1 if len(last) else near
    low = np.maximum(near - SLOP, last[doc]) if len(near) else near
    high = np.minimum(near + SLOP, last[doc] + words_of[doc] - 1) if len(near) else near
    for k in range(1, WINDOW):
        col = order[w, k]
        live = q.length[win[w]] > k
        key = q.term[win[w], col] * stride + start + col
        i = np.searchsorted(keys, key)
        ok = ~live | ((i < len(keys)) & (keys[np.minimum(i, len(keys) - 1)] == key) & (q.term[win[w], col] >= 0))
        w, start = w[ok], start[ok]
        col = order[w2, k]
        live = q.length[win[w2]] > k
        base = q.term[win[w2], col] * stride
        i = np.minimum(np.searchsorted(keys, base + low), max(len(keys) - 1, 0))
        ok = ~live | ((keys[i] >= base + low) & (keys[i] <= base + high)) if len(keys) else ~live
        w2, near, low, high = w2[ok], near[ok], low[ok], high[ok]
    return win[w], start, win[w2], near


def _query(q: Windows):
    groups, group_of = np.unique(q.group, return_inverse=True)

    def lists(key, docs, values):
        """The values of each document in ``docs`` (keys ascending) as an Arrow list."""
        return pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(key, docs), len(key)), pa.int32()), values)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                w, start, w2, near = matches(row, q)
                if not len(w2) and not len(w):
                    continue
                first = np.frombuffer(row["first"], np.int32).astype(np.int64)
                doc = lambda at: np.searchsorted(first, at, "right") - 1
                delta = np.zeros(row["span"] + 1, np.int64)
                np.add.at(delta, start, 1)
                np.add.at(delta, start + q.length[w], -1)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(delta) > 0).astype(np.int8), [0]])))
                a, b = edge[::2], edge[1::2]
                exact = np.unique(doc(start) * len(groups) + group_of[w])
                found = np.union1d(exact, doc(near) * len(groups) + group_of[w2])
                docs = np.unique(np.concatenate([doc(a), found // len(groups)]))
                ranges = pa.StructArray.from_arrays([pa.array(x - first[doc(a)], pa.int32()) for x in (a, b)], ["s", "e"])
                owned = pa.StructArray.from_arrays([pa.array(groups[found % len(groups)], pa.int64()), pa.array(np.isin(found, exact))], ["group", "exact"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), row["segment"]), pa.int64()), pa.array(docs, pa.int32()), lists(doc(a), docs, ranges), lists(found // len(groups), docs, owned)], ["segment", "place", "ranges", "owned"]
                )

    return run


HITS = "segment long, place int, ranges array<struct<s:int,e:int>>, owned array<struct<group:long,exact:boolean>>"


def _directory(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["doc_ids"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), row["segment"]), pa.int64()),
                    pa.array(np.arange(len(ids)), pa.int32()),
                    pa.array(ids, mask=np.frombuffer(row["nulls"], bool)),
                    pa.array(np.frombuffer(row["n_words"], np.int32), pa.int64()),
                ],
                ["segment", "place", "doc_id", "n_words"],
            )


def _blocks(windows: DataFrame):
    """The windows in blocks of about BLOCK_WINDOWS, one at a time."""
    n = windows.count()
    blocks = 1 if n <= BLOCK_WINDOWS else -(-2 * n // BLOCK_WINDOWS)
    for k in range(blocks if n else 0):
        part = (windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("terms"), F.lit(blocks)) == k)).toArrow().combine_chunks()
        if part.num_rows:
            terms, group = (part.column(c).combine_chunks() for c in ("terms", "group"))
            yield Windows(terms, group.to_numpy())


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, ranges (hit word ranges), items, near of every row."""
    index = build_index(docs)
    windows, owners = benchmark_windows(benchmark)
    hits = tb.no_rows(docs.sparkSession, HITS)
    for q in _blocks(windows):
        hits = hits.unionByName(tb.materialized(index.mapInArrow(_query(q), HITS), "benchmark-hits"))
    directory = index.select("segment", "doc_ids", "nulls", "n_words").mapInArrow(_directory, "segment long, place int, doc_id long, n_words long")
    own = hits.select("segment", "place", F.inline("owned")).join(owners, "group").groupBy("segment", "place", "item").agg(F.bool_or("exact").alias("exact"))
    items = own.groupBy("segment", "place").agg(F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"), F.array_sort(F.collect_list("item")).alias("near"))
    ranges = hits.groupBy("segment", "place").agg(F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"))
    none = F.array().cast("array<string>")
    return (
        directory.join(ranges, ["segment", "place"], "left")
        .join(items, ["segment", "place"], "left")
        .select("doc_id", "n_words", "ranges", *(F.coalesce(c, none).alias(c) for c in ("items", "near")))
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns, and n_near (items with a proximity match, exact ones included)."""
    union = F.expr("coalesce(aggregate(ranges, struct(0L as n, 0 as e), (a, r) -> struct(a.n + greatest(0, r.e - greatest(a.e, r.s)) as n, greatest(a.e, r.e) as e), a -> a.n), 0L)")
    return found.select(
        "doc_id",
        "n_words",
        union.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (union > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


def reject_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) without any benchmark window. A row is told by its id and a hash of its text."""
    key, name = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")), tb.free_name(docs, "llm_key")
    bad = decontaminate(docs.select(key.alias("doc_id"), "text"), benchmark).where(F.size("items") > 0).select(F.col("doc_id").alias(name)).distinct()
    return docs.withColumn(name, key).join(bad, name, "left_anti").select(*docs.columns)
