"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Method. Word, symbol, line and repetition counts of every whole text. Instead of fixed cutoffs, every
(language, source) gets its own: sketches of four ratios (counts of logarithmic bins, ``ACCURACY`` wide: mergeable by adding,
built map-side and merged in the shuffle, so a source with a third of all rows is reduced before it moves, and the same whatever the
partitions) give their quartiles, and the cutoff
is the far fence Q3 + FENCE * max(Q3 - Q1, floor), Q1 - ... for the lower side. The shares (repeated lines of the lines with a word,
words in repeated windows of the words) cannot pass a top (1, and the base rule's 0.5), so their fence is halfway from
Q3 to that top at most: every rule can fire in every group. With Q3 = Q1 = 0 that is 0.3 of the lines and 0.24 of the words. A joined filter then judges every row against
the cutoffs of its group. A group's sketch is mixed with that of all rows, scaled to the weight of ``PRIOR`` rows: a group of a
few rows is judged nearly as all rows are, a large one by itself, and no number of rows changes the rule.

Defined results: null or empty texts have no words and fail the base rule; null language or source is a group
value like any other; null ids and repeated rows are kept, each judged alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb

FENCE = 6.0
#: rows that the sketch of all rows weighs in a group's
PRIOR = 30
#: relative error of a quantile; ratios below SMALL are one bin
ACCURACY, SMALL = 0.01, 1e-4
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
MAX_BROADCAST_GROUPS = 100_000
_SYMBOL = tb.lookup(256, b"#*$%&|<>")
#: ratio -> smallest spread counted
RATIOS = {"symbol_ratio": 0.05, "dup_line_ratio": 0.05, "repeat_ratio": 0.04, "word_length": 0.5}
#: ratio -> the most it can be in a row that passes the base rule
TOPS = {"dup_line_ratio": 1.0, "repeat_ratio": 0.5}


def _counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    rows = len(off) - 1
    member = tb.WORD_BYTE[data]
    s, e = tb.runs(member, off)
    of = tb.row_of(s, off)
    count = lambda r, w=None: np.bincount(r, w, minlength=rows).astype(np.int64)
    n_words = count(of)
    points = np.concatenate([[0], np.cumsum(member & ((data & 0xC0) != 0x80))])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out = {"n_words": n_words, "word_chars": points[off[1:]] - points[off[:-1]], "n_symbols": symbols[off[1:]] - symbols[off[:-1]]}
    # lines that hold a word and equal an earlier line of the text
    ls, le = tb.runs(data != 10, off)
    lr = tb.row_of(ls, off)
    w = np.concatenate([[0], np.cumsum(member)])
    has = w[le] > w[ls]
    ls, le, lr = ls[has], le[has], lr[has]
    out["n_lines"] = count(lr)
    out["n_dup_lines"] = count(lr[_repeated(tb.run_hashes(data, ls, le), lr, later=True)])
    # words in three-word windows found twice or more in the text
    h = tb.run_hashes(data, s, e)
    n = len(h)
    covered = np.zeros(n, bool)
    if n > 2:
        with np.errstate(over="ignore"):
            k = np.uint64(0x9E3779B97F4A7C15)
            tri = tb.mix64((h[:-2] * k + h[1:-1]) * k + h[2:])
        inside = np.flatnonzero(of[:-2] == of[2:])
        twice = inside[_repeated(tri[inside], of[inside], later=False)]
        for j in range(3):
            covered[twice + j] = True
    out["n_repeat_words"] = count(of[covered])
    return out


def _repeated(h: np.ndarray, row: np.ndarray, later: bool) -> np.ndarray:
    """Mask of the values that occur twice or more in their row (later: all but the first)."""
    out = np.zeros(len(h), bool)
    if len(h) < 2:
        return out
    with np.errstate(over="ignore"):
        key = h ^ tb.mix64(row.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out[order[1:][same]] = True
    if not later:
        out[order[:-1][same]] = True
    return out


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = (*NAMES, "n_lines")
SCHEMA = "doc_id long, lang string, source string, " + ", ".join(f"{k} long" for k in MEASURES)


def _measure(batches):
    for rows, data, off in tb.text_slices(batches):
        c = _counts(data, off)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("lang"), rows.column("source"), *(pa.array(c[k], pa.int64()) for k in MEASURES)], ["doc_id", "lang", "source", *MEASURES])


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every row."""
    return tb.id_text(docs, F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")).mapInArrow(_measure, SCHEMA)


def _with_ratios(df: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return df.withColumns(
        {
            "symbol_ratio": F.col("n_symbols") / words,
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeat_ratio": F.col("n_repeat_words") / words,
            "word_length": F.col("word_chars") / words,
        }
    )


def _bin(c: Column) -> Column:
    """Bin of a ratio: 0 up to SMALL, then logarithmic."""
    return F.when(c <= SMALL, F.lit(0)).otherwise(F.ceil(F.log(c / SMALL) / float(np.log(GAMMA)))).cast("int")


def _value(bins: np.ndarray) -> np.ndarray:
    """The value that stands for a bin (within ACCURACY of all its values)."""
    return np.where(bins == 0, 0.0, SMALL * GAMMA ** bins.astype(np.float64) * 2 / (1 + GAMMA))


def _quantiles(bins: np.ndarray, weight: np.ndarray, at: tuple[float, ...]) -> list[float]:
    """Values below which the given shares of the weight lie."""
    order = np.argsort(bins, kind="stable")
    total = np.cumsum(weight[order])
    return [float(_value(bins[order])[min(np.searchsorted(total, p * total[-1] * (1 - 1e-12)), len(total) - 1)]) for p in at]


def _limits(whole: dict[str, tuple[np.ndarray, np.ndarray]]):
    """Sketches (lang, source, ratio -> bins and counts) -> fences, each mixed with that of all rows."""

    def fences(sketch: dict) -> list[float]:
        out = []
        for k, spread in RATIOS.items():
            bins, n = sketch[k]
            all_bins, all_n = whole[k]
            q1, q3 = _quantiles(np.concatenate([bins, all_bins]), np.concatenate([n, all_n * (PRIOR / all_n.sum())]), (0.25, 0.75))
            wide = max(q3 - q1, spread)
            top = q3 + FENCE * wide
            out.append(min(top, (q3 + TOPS[k]) / 2) if k in TOPS else top)
            if k == "word_length":
                out.append(q1 - FENCE * wide)
        return out

    def run(batches):
        for b in batches:
            rows = []
            for r in b.column("sketch").to_pylist():
                got = {k: ([], []) for k in RATIOS}
                for x in r:
                    got[x["ratio"]][0].append(x["bin"])
                    got[x["ratio"]][1].append(x["n"])
                rows.append(fences({k: (np.array(i, np.int64), np.array(n, np.float64)) for k, (i, n) in got.items()}))
            cols = np.array(rows, np.float64).reshape(len(rows), len(LIMITS)).T
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("source"), *(pa.array(c) for c in cols)], ["lang", "source", *LIMITS])

    return run


LIMITS = tuple(x for k in RATIOS for x in ((f"{k}_max", f"{k}_min") if k == "word_length" else (f"{k}_max",)))


def cutoffs(measured: DataFrame) -> tuple[DataFrame, dict]:
    """(lang, source and the fences of every group with a row that passes the base rule; the sketch of all rows)."""
    rows = _with_ratios(measured).where(~base_failed())
    one = F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), _bin(F.col(k)).alias("bin")) for k in RATIOS]))
    bins = rows.select("lang", "source", one.alias("x")).groupBy("lang", "source", "x.ratio", "x.bin").agg(F.count("*").alias("n"))
    bins = tb.materialized(bins, "quality-sketches")
    # the sketch of all rows: some thousand bins at most
    whole = {k: ([], []) for k in RATIOS}
    for r in bins.groupBy("ratio", "bin").agg(F.sum("n").alias("n")).collect():
        whole[r.ratio][0].append(r.bin)
        whole[r.ratio][1].append(r.n)
    whole = {k: (np.array(i, np.int64)[np.argsort(i)], np.array(n, np.float64)[np.argsort(i)]) for k, (i, n) in whole.items()}
    sketches = bins.groupBy("lang", "source").agg(F.collect_list(F.struct("ratio", "bin", "n")).alias("sketch"))
    return sketches.mapInArrow(_limits(whole), "lang string, source string, " + ", ".join(f"{k} double" for k in LIMITS)), whole


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row."""
    measured = tb.materialized(measures(docs), "quality-measures")
    groups = tb.materialized(cutoffs(measured)[0].withColumnsRenamed({"lang": "g_lang", "source": "g_source"}), "quality-cutoffs")
    groups = tb.checked_broadcast(groups, MAX_BROADCAST_GROUPS)
    rows = _with_ratios(measured)
    joined = rows.join(groups, rows["lang"].eqNullSafe(groups["g_lang"]) & rows["source"].eqNullSafe(groups["g_source"]), "left")
    inside = F.col("word_length") >= F.col("word_length_min")
    for k in RATIOS:
        inside = inside & (F.col(k) <= F.col(f"{k}_max"))
    # a group without cutoffs has no row that passes the base rule
    return joined.select("doc_id", *NAMES, base_failed().alias("base_failed"), (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"))
