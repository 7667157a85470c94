"""Toxicity: character n-gram linear classifier scaled by naive Bayes log-count ratios.

Method. Texts become sets of hashed character n-grams (orders ``ORDERS``, A-Z lower-cased,
runs of white space as one space). The log-count ratios r = log(p/|p|) - log(q/|q|) come from the document frequencies
over *all* labelled training rows (one distributed pass). A logistic model on the r-scaled
features is fitted on a bounded, documented sample (``SAMPLE_PER_CLASS`` different texts of each class,
the smallest by a hash of the text); scoring reads every whole text.

Defined results: a null or empty text scores by the intercept alone; null ids are kept and count as held in;
repeated rows score alike; without any label of both classes every score is 0.
``lang``, ``source`` and ``doc_id`` never enter a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb

ORDERS = (3, 4, 5)
BITS = 18
#: labelled rows of each class that the linear model is fitted on
SAMPLE_PER_CLASS = 1500
BLOCK = 4096
MAX_BROADCAST_LABELS = 2_000_000


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _normal(data: np.ndarray) -> bytes:
    return b" ".join(bytes(data).translate(tb.LOWER).split())


def features(data: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distinct n-gram buckets of one text (its UTF-8 bytes)."""
    c = _codes(" " + _normal(data).decode("utf-8", "replace") + " ").astype(np.uint64)
    parts = []
    with np.errstate(over="ignore"):
        h = c.copy()
        for n in range(2, max(ORDERS) + 1):
            if len(c) < n:
                break
            h = h[:-1] * np.uint64(0x100000001B3) + c[n - 1 :]
            if n in ORDERS:
                parts.append(((h ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits))
    if not parts:
        return np.zeros(0, np.int64)
    idx = np.concatenate(parts).astype(np.int64)
    seen = _stamp(bits)
    order = np.arange(len(idx), dtype=np.int32)
    seen[idx] = order
    return idx[seen[idx] == order]


_STAMPS: dict[int, np.ndarray] = {}


def _stamp(bits: int) -> np.ndarray:
    if bits not in _STAMPS:
        _STAMPS[bits] = np.zeros(1 << bits, np.int32)
    return _STAMPS[bits]


def _count(batches):
    """Per task: document frequency of each bucket by class, as blocks of the vector."""
    totals = np.zeros((2, 1 << BITS), np.int64)
    n = np.zeros(2, np.int64)
    for rows, data, off in tb.text_slices(batches):
        toxic = rows.column("toxic").to_numpy(zero_copy_only=False)
        for i in range(len(toxic)):
            totals[toxic[i], features(data[off[i] : off[i + 1]])] += 1
            n[toxic[i]] += 1
    if n.sum():
        blocks = (1 << BITS) // BLOCK
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(range(blocks + 1), pa.int32()),
                "counts": pa.array([totals[:, i * BLOCK : (i + 1) * BLOCK].tobytes() for i in range(blocks)] + [n.tobytes()], pa.binary()),
            }
        )


def _add_partial(batches):
    """Sum the blocks of one shuffle partition, so that no block meets all tasks' vectors at once."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, v in zip(b.column("block").to_pylist(), b.column("counts")):
            x = np.frombuffer(v.as_buffer(), np.int64)
            sums[k] = sums[k] + x if k in sums else x
    if sums:
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "counts": pa.array([v.tobytes() for v in sums.values()], pa.binary())})


def log_count_ratios(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(r, documents per class). The driver receives one fixed-size vector of 2^BITS buckets."""
    schema = "block int, counts binary"
    parts = labelled.select("text", "toxic").mapInArrow(_count, schema)
    blocks = (1 << BITS) // BLOCK
    rows = parts.repartition(blocks + 1, "block").mapInArrow(_add_partial, schema).collect()
    got = np.zeros((2, 1 << BITS))
    n = np.zeros(2)
    for row in rows:
        x = np.frombuffer(row["counts"], np.int64)
        if row["block"] == blocks:
            n += x
        else:
            got[:, row["block"] * BLOCK : (row["block"] + 1) * BLOCK] += x.reshape(2, -1)
    p, q = got[1] + 1.0, got[0] + 1.0
    r = np.log(p / (n[1] + 2.0)) - np.log(q / (n[0] + 2.0))
    r[got.sum(axis=0) == 0] = 0.0  # in no labelled document: nothing is known of it
    return r.astype(np.float32), n


#: documents whose features are expanded at a time while fitting
CHUNK = 100


def fit(samples: list[tuple[bytes, int]], r: np.ndarray, steps: int = 40, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on r-scaled, length-normalised features: full-batch Adam, gradients summed over
    chunks of documents, so that memory is 4 bytes a feature of the sample."""
    y = np.array([v for _, v in samples], np.float32)
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)).astype(np.float32)
    chunks = []
    for lo in range(0, len(samples), CHUNK):
        active, scale = [], []
        for t, _ in samples[lo : lo + CHUNK]:
            f = features(np.frombuffer(t, np.uint8))
            scale.append(1 / np.sqrt(len(f) + 1))
            active.append(f[r[f] != 0].astype(np.int32))
        chunks.append((slice(lo, lo + len(active)), np.concatenate(active), [len(a) for a in active], np.array(scale, np.float32)))
    w, b = np.ones(len(r), np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        grad, gb = l2 * (w - 1) / len(y), 0.0
        scaled = w * r
        for at, idx, sizes, scale in chunks:
            row = np.repeat(np.arange(len(sizes)), sizes)
            z = np.bincount(row, scaled[idx], len(sizes)) * scale + b
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]) * weight[at]
            grad += np.bincount(idx, (g * scale)[row], len(r)) * r
            gb += float(g.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w = (w - 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
        b -= 0.1 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return (w * r).astype(np.float32), b


class Model:
    """r-scaled weights per bucket; a text's sum is divided by the root of its number of features."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, float(intercept)

    def score(self, data: np.ndarray) -> float:
        idx = features(data)
        z = self.weights[idx].sum(dtype=np.float64) / np.sqrt(len(idx) + 1) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic of the labelled documents outside the held-out fold. Labels that repeat an id
    with differing values count by their larger value."""
    by_id = training_labels(labels)
    return tb.id_text(docs).join(tb.checked_broadcast(by_id, MAX_BROADCAST_LABELS), "doc_id")


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic outside the held-out fold, each id once."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )


def sample_of(rows: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> list[tuple[bytes, int]]:
    """At most ``per_class`` different texts of each class with their labels, the smallest by a hash of the text: copies count
    once. The hashes are ranked first, without texts; then the chosen texts are fetched, one for each hash."""
    text = F.coalesce("text", F.lit(""))
    hashed = rows.select(F.xxhash64(text).alias("h"), "toxic", text.alias("text"))
    out = []
    for k in (0, 1):
        own = hashed.where(F.col("toxic") == k)
        last = own.select("h").distinct().orderBy("h").limit(per_class).agg(F.max("h")).first()[0]
        if last is not None:
            texts = own.where(F.col("h") <= last).groupBy("h").agg(F.min(F.encode("text", "utf-8")).alias("text")).collect()
            out += [(bytes(x["text"]), k) for x in sorted(texts, key=lambda x: x["h"])]
    return out


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """None if the training labels hold one class or none."""
    rows = training_rows(docs, labels)
    r, n = log_count_ratios(rows)
    if n.min() == 0:
        return None
    weights, b = fit(sample_of(rows), r)
    return Model(weights, b)


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score of every row."""

    def score(batches):
        for rows, data, off in tb.text_slices(batches):
            s = [model.score(data[off[i] : off[i + 1]]) if model else 0.0 for i in range(rows.num_rows)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    return tb.id_text(docs).mapInArrow(score, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return score_documents(docs, train(docs, labels)).select(
        "doc_id",
        F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5."""
    model = train(docs, labels)
    return tb.bounded_batches(docs).mapInArrow(_keep(model), docs.schema)


def _keep(model: Model | None):
    """Rows whose text scores below 0.5, handed on slice by slice: neither side holds a second copy of a whole batch."""

    def run(batches):
        for rows, data, off in tb.text_slices(batches):
            ok = [not model or model.score(data[off[i] : off[i + 1]]) < 0.5 for i in range(rows.num_rows)]
            yield rows.filter(pa.array(ok, pa.bool_()))

    return run
