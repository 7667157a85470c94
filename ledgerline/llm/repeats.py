"""Exact repeated-substring removal: depth-limited radix sort of suffixes.

Method. Suffixes are ordered through 100 bytes only, by most-significant-digit passes over hashed
digits; after each pass groups of one are dropped, and what is equal through the last
pass is exactly a repeated 100-byte string. Only suffixes at anchors take part: the anchor of a 100-byte string is
the position of its smallest 32-byte hash (leftmost of ties), so equal strings have equal anchors at equal offsets, and
about one position in 35 is an anchor. A cell is the run of strings of a document with the same anchor.

1. digit: the 32 bytes at the anchor, (distribution pass: its top bits deal the cells to groups of bounded size);
2. digit: the whole cell (up to 168 bytes). Cells equal to an earlier one repeat in every string;
   the first of each kind stays for the next pass;
3. digit: 34 bytes to the left or right of the anchor's 32. Any string reaches that far on one side, so
   first cells that share neither with another are done;
4. digit: the 100 bytes themselves; every string but the first of its kind by (doc_id, start) repeats.

Equal cells (and strings) within a slice are reduced to their first before the shuffle, so thousands of copies send
a few rows each; a gram with more than ``HOT`` different first cells in a slice skips to digit 4, and a mark
makes the others of that gram follow, so no group holds a common passage's every surrounding. Digits are 64-bit hashes; cells are equal if 128 bits agree (the anchor's and
the cell's), strings if 96 bits of two hashes do. Bytes are not compared again.

Defined results: null and empty texts have nothing to remove; texts under 100 bytes stay whole; a null doc_id comes
before all others; rows that repeat a doc_id with the same text count as one document and each gets its
result; rows that repeat a doc_id with different texts are ordered by the digest of the text (``version``: 60 bits of its md5,
checked against the whole digest; other bits are taken if two texts of an id should share them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb

LENGTH, GRAM = 100, 32
SPREAD = LENGTH - GRAM + 1
SIDE = (LENGTH - GRAM) // 2
CELLS_A_GROUP = 100_000
#: bytes hashed at a time; a dozen 8-byte arrays of that length are alive
SLICE = 1 << 19
NO_ID = -(1 << 63)
#: low bits of a packed (hash, position): a slice is under 2 GB, as any text is
PLACE_BITS = 31
#: a gram with more first cells in one slice goes straight to the last digit
HOT = 8
CELL, REPEAT, LOOK, MARK = 0, 1, 2, 3
#: ids (12 bytes each) that are broadcast at most; beyond, the same join shuffles
MAX_BROADCAST_IDS = 2_000_000


def _window_hashes(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the 2, 4, 32, 64 bytes from each position, by doubling."""
    out = {}
    with np.errstate(over="ignore"):
        h, n = tb.BYTE_VALUE[data], 1
        while n < 64:
            m = len(h) - n
            if m <= 0:
                break
            h = h[:m] * np.uint64(0x9E3779B97F4A7C15 + 2 * n) + h[n:]
            h ^= h >> np.uint64(29)
            n *= 2
            if n == GRAM:
                h = tb.mix64(h)
            if n in (2, 4, 32, 64):
                out[n] = h
    return out


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tb.mix64(a * np.uint64(0xC2B2AE3D27D4EB4F) + b)


def other_hashes(w: dict[int, np.ndarray], start: np.ndarray) -> np.ndarray:
    """32 more bits of hash of the same strings, from other parts of them."""
    return (_join(_join(w[4][start], w[32][start + 4]), w[64][start + 36]) >> np.uint64(32)).astype(np.uint32)


def string_hashes(w: dict[int, np.ndarray], start: np.ndarray) -> np.ndarray:
    """Hashes of the 100-byte strings at ``start``."""
    return _join(_join(w[64][start], w[32][start + 64]), w[4][start + 96])


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest hash (leftmost of ties) in h[i : i + width], for every whole window."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    v = ((h >> np.uint64(PLACE_BITS)) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    pad = -len(v) % width
    v = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    right = np.minimum.accumulate(v, axis=1).ravel()
    left = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(left[:n], right[width - 1 : width - 1 + n])
    return (best & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


def cells(data: np.ndarray, off: np.ndarray):
    """The cells of a slice: dict of arrays (row, start, size, gram, cell, left, right), and the hashes."""
    if len(data) < LENGTH:
        return None, None
    w = _window_hashes(data)
    anchor = sliding_argmin(w[32], SPREAD)[: len(data) - LENGTH + 1]
    n = len(anchor)
    row_end = np.repeat(off[1:], np.diff(off))[:n]
    valid = np.arange(n) + LENGTH <= row_end
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    head = valid.copy()
    head[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    tail = valid.copy()
    tail[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first, last = np.flatnonzero(head), np.flatnonzero(tail)
    p = anchor[first]
    shape = ((p - first) << 8 | (last - first)).astype(np.uint64)
    # the smallest of 69 hashes is a small number: mixed again, its top bits deal evenly
    gram = tb.mix64(w[32][p])
    cell = _join(_join(string_hashes(w, first), string_hashes(w, last)), shape)
    has_left, has_right = p - first >= SIDE, last + LENGTH - (p + GRAM) >= SIDE
    left, right = np.zeros(len(p), np.uint16), np.zeros(len(p), np.uint16)
    side = lambda at: (_join(w[64][at], w[2][at + 64]) >> np.uint64(48)).astype(np.uint16) | 1
    left[has_left] = side(p[has_left] - SIDE)
    right[has_right] = side(p[has_right])
    return {"row": row[first], "start": (first - off[row[first]]).astype(np.int32), "size": (last - first + 1).astype(np.uint8), "gram": gram, "cell": cell, "left": left, "right": right}, w


_PARTS = (("gram", np.uint64), ("cell", np.uint64), ("doc", np.int64), ("version", np.int64), ("start", np.int32), ("size", np.uint8), ("left", np.uint16), ("right", np.uint16), ("kind", np.uint8))


def _first_of(c: dict, *keys: str) -> tuple[dict, np.ndarray, np.ndarray]:
    """Rows ordered by the keys, then document and start; the first of each key; rows at the same place as their first
    (a document row that occurs twice)."""
    order = np.lexsort((c["start"], c["version"], c["doc"], *(c[k] for k in reversed(keys))))
    c = {k: v[order] for k, v in c.items()}
    first = np.ones(len(order), bool)
    first[1:] = np.logical_or.reduce([c[k][1:] != c[k][:-1] for k in keys])
    lead = np.flatnonzero(first)[np.cumsum(first) - 1]
    again = ~first & np.logical_and.reduce([c[k] == c[k][lead] for k in ("doc", "version", "start")])
    return c, first, again


def _dealt(c: dict, parts, digit: np.ndarray) -> pa.RecordBatch:
    """One row for each digit, its arrays packed."""
    order = np.argsort(digit, kind="stable")
    digit = digit[order]
    cut = np.flatnonzero(np.diff(digit)) + 1
    lo, hi = np.concatenate([[0], cut]).astype(np.int64), np.concatenate([cut, [len(digit)]]).astype(np.int64)
    columns = {"digit": pa.array(digit[lo], pa.int32())}
    for k, t in parts:
        v = c[k][order].astype(t)
        columns[k] = pa.array([v[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def _top(h: np.ndarray, bits: int) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _distribute(bits: int):
    def run(batches):
        for rows, data, off in tb.text_slices(batches, SLICE):
            c, _ = cells(data, off)
            if c is None or not len(c["row"]):
                continue
            row = c.pop("row")
            c["doc"] = rows.column("id").to_numpy(zero_copy_only=False)[row]
            c["version"] = rows.column("version").to_numpy(zero_copy_only=False)[row]
            c, first, again = _first_of(c, "gram", "cell")
            c["kind"] = np.where(first, CELL, REPEAT).astype(np.uint8)
            c = {k: v[~again] for k, v in c.items()}
            # grams of many first cells in this slice
            lead = np.flatnonzero(c["kind"] == CELL)
            grams, of, n = np.unique(c["gram"][lead], return_inverse=True, return_counts=True)
            hot = n[of] > HOT
            c["kind"][lead[hot]] = LOOK
            if hot.any():
                marks = {k: np.zeros(int((n > HOT).sum()), v.dtype) for k, v in c.items()}
                marks["gram"] = grams[n > HOT]
                marks["kind"][:] = MARK
                c = {k: np.concatenate([v, marks[k]]) for k, v in c.items()}
            # what is settled here needs no group; it rides along, spread by document
            group = (c["kind"] == CELL) | (c["kind"] == MARK)
            digit = np.where(group, _top(c["gram"], bits), _top(tb.mix64(c["doc"].view(np.uint64)), bits))
            yield _dealt(c, _PARTS, digit)

    return run


PACKED = "digit int, " + ", ".join(f"{k} binary" for k, _ in _PARTS)


def _unpacked(table: pa.Table, parts) -> dict:
    return {k: np.frombuffer(b"".join(x.as_py() for x in table.column(k)), t) for k, t in parts}


def _refine(key, table):
    """Digits 1 to 3 over one group of grams: repeated cells (kind REPEAT) and cells to look into (LOOK)."""
    c = _unpacked(table, _PARTS)
    kind = c["kind"]
    settled = {k: v[(kind == REPEAT) | (kind == LOOK)] for k, v in c.items()}
    marked = np.unique(c["gram"][kind == MARK])
    c = {k: v[kind == CELL] for k, v in c.items()}
    c, first, again = _first_of(c, "gram", "cell")
    repeat = {k: v[~first & ~again] for k, v in c.items()}
    lead = {k: v[first] for k, v in c.items()}
    g = lead["gram"]
    shared = np.zeros(len(g), bool)
    if len(g):
        new = np.ones(len(g), bool)
        new[1:] = g[1:] != g[:-1]
        group = np.cumsum(new) - 1
        near = np.zeros(len(g), bool)
        for side in ("left", "right"):
            k = (group.astype(np.int64) << 17) | lead[side].astype(np.int64)
            _, inv, n = np.unique(k, return_inverse=True, return_counts=True)
            near |= (n[inv] > 1) & (lead[side] > 0)
        shared = ((np.bincount(group)[group] > 1) & near) | np.isin(g, marked)
    look = {k: v[shared] for k, v in lead.items()}
    col = lambda k: np.concatenate([settled[k], repeat[k], look[k]])
    kinds = np.concatenate([settled["kind"], np.full(len(repeat["doc"]), REPEAT), np.full(len(look["doc"]), LOOK)]).astype(np.int8)
    return pa.table({"kind": pa.array(kinds, pa.int8()), "id": pa.array(col("doc"), pa.int64()), "version": pa.array(col("version"), pa.int64()), "start": pa.array(col("start"), pa.int32()), "size": pa.array(col("size"), pa.int16())})


SPANS = "kind byte, id long, version long, start int, size short"


_STRING = (("h", np.uint64), ("h2", np.uint32), ("doc", np.int64), ("version", np.int64), ("start", np.int32), ("kind", np.uint8))
PACKED_STRINGS = "digit int, " + ", ".join(f"{k} binary" for k, _ in _STRING)


def _strings(bits: int):
    """Rows (id, version, text, wanted cells) -> the 100-byte strings of those cells, dealt by their hash."""

    def run(batches):
        for rows, data, off in tb.text_slices(batches, SLICE):
            w = _window_hashes(data)
            if 64 not in w:
                continue
            wanted = rows.column("wanted")
            n = np.diff(wanted.offsets.to_numpy())
            flat = wanted.flatten()
            start = flat.field("start").to_numpy().astype(np.int64)
            size = flat.field("size").to_numpy().astype(np.int64)
            total = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            at = np.repeat(start - total[:-1], size) + np.arange(total[-1])
            row = np.repeat(np.repeat(np.arange(len(n)), n), size)
            c = {
                "h": string_hashes(w, off[row] + at),
                "h2": other_hashes(w, off[row] + at),
                "doc": rows.column("id").to_numpy()[row],
                "version": rows.column("version").to_numpy()[row],
                "start": at,
            }
            c, first, again = _first_of(c, "h", "h2")
            c["kind"] = np.where(first, CELL, REPEAT).astype(np.uint8)
            c = {k: v[~again] for k, v in c.items()}
            digit = np.where(c["kind"] == CELL, _top(c["h"], bits), _top(tb.mix64(c["doc"].view(np.uint64)), bits))
            yield _dealt(c, _STRING, digit)

    return run


def _late(key, table):
    """Digit 4: every string but the first of its kind."""
    c = _unpacked(table, _STRING)
    settled = {k: v[c["kind"] == REPEAT] for k, v in c.items()}
    c, first, again = _first_of({k: v[c["kind"] == CELL] for k, v in c.items()}, "h", "h2")
    late = ~first & ~again
    col = lambda k: np.concatenate([settled[k], c[k][late]])
    n = len(settled["doc"]) + int(late.sum())
    return pa.table({"id": pa.array(col("doc"), pa.int64()), "version": pa.array(col("version"), pa.int64()), "start": pa.array(col("start"), pa.int32()), "size": pa.array(np.ones(n), pa.int16())})


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the byte ranges [start, start + size - 1 + LENGTH)."""
    order = np.argsort(start, kind="stable")
    s, e = start[order].astype(np.int64), (start + size - 1 + LENGTH)[order].astype(np.int64)
    if not len(s):
        return s, e
    top = np.maximum.accumulate(e)
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > top[:-1]
    at = np.flatnonzero(new)
    return s[at], top[np.append(at[1:], len(s)) - 1]


def _remove(batches):
    for rows, data, off in tb.text_slices(batches, SLICE):
        spans = rows.column("spans")
        out = []
        for i in range(rows.num_rows):
            text = data[off[i] : off[i + 1]]
            own = spans[i].values if spans[i].is_valid else None
            if own is None or not len(own):
                out.append((len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                continue
            s, e = _ranges(own.field("start").to_numpy(), own.field("size").to_numpy().astype(np.int64))
            keep = np.ones(len(text), bool)
            for a, b in zip(s, e):
                keep[a:b] = False
            out.append((len(text), int((~keep).sum()), len(s), hashlib.sha256(text[keep].tobytes()).hexdigest()))
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


#: hex digits of the md5 that make a version: the first 60 bits, else others
DIGITS = ((1, 15), (16, 15), (9, 15), (5, 15))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, id (nulls as the smallest number), version, text; id and version are the identity of a document. The version is 0 for
    ids of one text, so it takes no room in what is shuffled."""
    rows = tb.id_text(docs).select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text")
    digest = F.md5(F.coalesce("text", F.lit("")))
    held = rows.select("id", digest.alias("digest"))
    several = held.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b")
    several = tb.materialized(several.select(F.col("id").alias("several")), "ids-of-several-texts")
    if several.isEmpty():
        return rows.select("doc_id", "id", F.lit(0).cast("long").alias("version"), "text")
    several = tb.checked_broadcast(several, MAX_BROADCAST_IDS)
    theirs = held.join(several, held["id"] == several["several"], "left_semi")
    for first, length in DIGITS:
        version = lambda d: F.conv(F.substring(d, first, length), 16, 10).cast("long")  # noqa: E731, B023
        found = theirs.groupBy("id", version(F.col("digest")).alias("version")).agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
        if found.where("a <> b").isEmpty():
            own = F.when(F.col("several").isNull(), F.lit(0).cast("long")).otherwise(version(digest))
            return rows.join(several, rows["id"] == several["several"], "left").select("doc_id", "id", own.alias("version"), "text")
    raise ValueError("texts of one doc_id share every part of their digests")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """id, version, start, size: runs of ``size`` string starts from ``start`` that occur earlier, too. ``texts`` as of ``_texts``."""
    spark = texts.sparkSession
    texts = texts.select("id", "version", "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = tb.shuffle_tasks(spark)
    groups = max(4 * tasks, total // 35 // CELLS_A_GROUP)
    bits = min(30, max(1, int(groups - 1).bit_length()))
    packed = texts.mapInArrow(_distribute(bits), PACKED)
    found = tb.materialized(packed.groupBy("digit").applyInArrow(_refine, SPANS), "repeat-cells")
    wanted = found.where(F.col("kind") == LOOK).groupBy("id", "version").agg(F.collect_set(F.struct("start", F.col("size").cast("int").alias("size"))).alias("wanted"))
    # texts that hold no such cell stay where they are as long as the others' ids can be sent to the scan
    named = tb.checked_broadcast(wanted.select("id", "version"), MAX_BROADCAST_IDS)
    strings = texts.join(named, ["id", "version"], "left_semi").join(wanted, ["id", "version"]).mapInArrow(_strings(bits), PACKED_STRINGS)
    late = strings.groupBy("digit").applyInArrow(_late, "id long, version long, start int, size short")
    return found.where(F.col("kind") == REPEAT).select("id", "version", "start", "size").unionByName(late)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    texts = _texts(docs)
    # copies of a document's row send the same spans: a set of them, collapsed before the shuffle
    spans = repeated_spans(texts).groupBy("id", "version").agg(F.collect_set(F.struct("start", F.col("size").cast("int").alias("size"))).alias("spans"))
    return texts.join(spans, ["id", "version"], "left").select("doc_id", "text", "spans").mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
