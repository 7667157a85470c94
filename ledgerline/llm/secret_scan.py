"""Secret scan: three base patterns plus a character convolutional network over candidates.

Method. One pass over every whole text finds (a) the base spans of ``assign``, ``access``
and ``hex`` and (b) candidates: maximal runs of 12 or more characters from
``[A-Za-z0-9+/_=-]`` holding a digit, or ``LETTERS`` letters in a row (``DIFFERENT`` different ones at least), each
with ``CONTEXT`` characters of surrounding text on both sides. What a run holds beside a base span is a candidate of its own if it is one by
itself; it is judged with the base spans blanked in its context. Candidates are judged as a whole: one that with its
surroundings is longer than the network's ``WINDOW`` gets windows every ``STEP`` characters, the last ending ``CONTEXT`` after the run, and the
highest score counts. Texts without the
literal beginnings of a pattern skip the regular expressions (a necessary condition, so
nothing is lost). A character CNN (embedding, two convolution widths, max-pooling, logistic output;
numpy only) is trained on all different labelled findings (copies count once): candidates inside base spans (the part inside the base
finding's value) are positive, the others unlabelled. A positive is shown as it is
and with the surroundings of an unlabelled candidate, so that its shape has to be learnt and not the base keyword.
Unlabelled candidates may be secrets that the base patterns miss: those that a network fitted on the other
half of them scores like the positives are left out, the rest are the negatives.
Its scores are calibrated by a logistic (Platt) fit on the quarter of the candidates that training did not see, and the threshold
is the highest that keeps a recall of ``RECALL`` there, among the positives as they are and among those in other surroundings.
Candidates at or above it become ``cnn`` spans.

Training is shared out: candidates are dealt by hash into parts of about ``TRAIN_PER_CLASS`` of a class, a task fits the network on its
part, and the mean of the parts' weights starts the next of ``ROUNDS`` rounds (one round if there is one part). Bars and the threshold are
exact order statistics of all scores, counted in two histograms. The driver sees weights, counts and histograms only.

Defined results: null or empty texts have no spans; without two different findings of both classes the network adds
nothing; null ids and repeated rows are kept, each row judged alone.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb

CONTEXT = 24
WINDOW = 96
STEP = 24
#: candidates of a class in a part of the training rows, about; a class with fewer than ``PART_LEAST`` a part is dealt more than once
TRAIN_PER_CLASS, PART_LEAST = 1000, 16
#: times that the parts' weights are averaged
ROUNDS = 3
RECALL = 0.98
KINDS = ("assign", "access", "hex", "cnn")
#: letters in a row that make a run without digits a candidate
LETTERS, DIFFERENT = 24, 8
#: label of a candidate beside a base span, in one run with it: not for training
REST = 2

# fixed values: the base patterns
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_LETTERS = re.compile(rf"[A-Za-z]{{{LETTERS},}}")
_LETTER_BYTE = tb.lookup(256, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_CANDIDATE_BYTE = tb.lookup(256, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_HEX_BYTE = tb.lookup(256, b"0123456789abcdef")
_DIGIT_BYTE = tb.lookup(256, b"0123456789")

FINDINGS = "array<struct<kind:string,start:int,end:int,context:string,at:int,label:int>>"


def _base(text: str) -> list[tuple[str, int, int, int]]:
    """Kind, start, end and start of the secret value of each base span."""
    found = [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans of one text: by start, then kind as listed."""
    return [s[:3] for s in _base(text)]


def candidate_spans(text: str) -> list[tuple[int, int]]:
    telling = lambda run: re.search("[0-9]", run) or any(len(set(w)) >= DIFFERENT for w in _LETTERS.findall(run))
    return [m.span() for m in CANDIDATE.finditer(text) if telling(m.group())]


def _merged(ranges) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def labelled_candidates(text: str, base: list[tuple[str, int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) by candidate run: 0 a run without base span; otherwise those of its parts inside base values (1, for
    training only) and outside base spans (REST) that are candidates themselves."""
    out = []

    def add(a: int, b: int, label: int) -> None:
        out.extend((a + p, a + q, label) for p, q in candidate_spans(text[a:b]))

    spans_, values = _merged((s, e) for _, s, e, _ in base), _merged((v, e) for _, _, e, v in base)
    i = j = 0
    for s, e in candidate_spans(text):
        while i < len(spans_) and spans_[i][1] <= s:
            i += 1
        while j < len(values) and values[j][1] <= s:
            j += 1
        if i == len(spans_) or spans_[i][0] >= e:
            out.append((s, e, 0))
            continue
        for k in range(j, len(values)):
            if values[k][0] >= e:
                break
            add(max(s, values[k][0]), min(e, values[k][1]), 1)
        at = s
        for k in range(i, len(spans_)):
            if spans_[k][0] >= e:
                break
            add(at, max(at, spans_[k][0]), REST)
            at = spans_[k][1]
        add(at, max(at, e), REST)
    return out


def blanked(text: str, lo: int, hi: int, ranges: list[tuple[int, int]]) -> str:
    """text[lo:hi] with a NUL for each character in ``ranges`` (ascending, disjoint)."""
    out, at = [], lo
    for a, b in ranges[bisect_right(ranges, lo, key=lambda r: r[1]) :]:
        if a >= hi:
            break
        a, b = max(a, lo), min(b, hi)
        out += [text[at:a], "\0" * (b - a)]
        at = b
    return "".join(out) + text[at:hi]


def _long_runs(member: np.ndarray, data: np.ndarray, off: np.ndarray, least: int, need: np.ndarray | None = None) -> np.ndarray:
    """Rows with a run of ``least`` member bytes (holding a ``need`` byte)."""
    s, e = tb.runs(member[data], off)
    long = e - s >= least
    s, e = s[long], e[long]
    if need is not None and len(s):
        n = np.zeros(len(data) + 1, np.int32)
        np.cumsum(need[data], out=n[1:])
        s = s[n[e] > n[s]]
    return np.unique(tb.row_of(s, off))


def _literal_rows(data: bytes, words, off: np.ndarray) -> np.ndarray:
    at = []
    for w in words:
        i = data.find(w)
        while i >= 0:
            at.append(i)
            i = data.find(w, i + 1)
    return np.unique(tb.row_of(np.array(at, np.int64), off))


def _extract(batches):
    for rows, data, off in tb.text_slices(batches):
        raw = bytes(data)
        wanted = np.zeros(rows.num_rows, bool)
        for found in (
            _literal_rows(raw.translate(tb.LOWER), WORDS, off),
            _literal_rows(raw, (b"AKIA",), off),
            _long_runs(_HEX_BYTE, data, off, 32),
            _long_runs(_CANDIDATE_BYTE, data, off, 12, _DIGIT_BYTE),
            _long_runs(_LETTER_BYTE, data, off, LETTERS),
        ):
            wanted[found] = True
        out = []
        for i in range(rows.num_rows):
            if not wanted[i]:
                out.append([])
                continue
            text = raw[off[i] : off[i + 1]].decode("utf-8", "replace")
            spans = _base(text)
            items = [{"kind": k, "start": s, "end": e, "context": None, "at": 0, "label": 1} for k, s, e, _ in spans]
            ranges = _merged((s, e) for _, s, e, _ in spans)
            for s, e, label in labelled_candidates(text, spans):
                lo, hi = max(0, s - CONTEXT), max(s + WINDOW - CONTEXT, e + CONTEXT)
                context = blanked(text, lo, min(hi, len(text)), ranges) if label == REST else text[lo:hi]
                items.append({"kind": "cnn", "start": s, "end": e, "context": context, "at": s - lo, "label": label})
            out.append(items)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("context", pa.string()), ("at", pa.int32()), ("label", pa.int32())])))],
            ["doc_id", "findings"],
        )


def findings(docs: DataFrame) -> DataFrame:
    """doc_id, findings (base spans, then candidates with context and weak label) of every row."""
    return tb.id_text(docs).mapInArrow(_extract, f"doc_id long, findings {FINDINGS}")


def windows(context: str, at: int, length: int):
    """(window's text, position of CONTEXT characters into the window) over a whole run and its surroundings."""
    last = max(0, length - (WINDOW - 2 * CONTEXT))
    for o in [*range(0, last, STEP), last]:
        lo = max(0, at + o - CONTEXT)
        yield context[lo : at + o + WINDOW - CONTEXT], at + o - lo


class CharCNN:
    """Character embedding -> convolutions of widths 3 and 5 -> ReLU -> max-pool -> logistic."""

    CHARS, DIM, FILTERS, WIDTHS = 100, 12, 16, (3, 5)

    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        f = lambda *s: (g.standard_normal(s) * (2 / np.prod(s[:-1])) ** 0.5).astype(np.float32)
        self.p = {"embed": f(self.CHARS, self.DIM), "out": f(self.FILTERS * len(self.WIDTHS), 1)[:, 0], "bias": np.zeros(1, np.float32)}
        for w in self.WIDTHS:
            self.p[f"conv{w}"] = f(w * self.DIM, self.FILTERS)
            self.p[f"shift{w}"] = np.zeros(self.FILTERS, np.float32)
        self.slope, self.offset, self.threshold = 1.0, 0.0, 0.5

    @staticmethod
    def encode(contexts: list[str], at: list[int]) -> np.ndarray:
        """Codes of a fixed window with the candidate's first character at position CONTEXT.
        0 pads, 1 is any character outside printable ASCII, digits and case are kept."""
        x = np.zeros((len(contexts), WINDOW), np.int64)
        for i, (c, a) in enumerate(zip(contexts, at)):
            v = np.frombuffer(c.encode("utf-32-le", "surrogatepass"), np.uint32)[:WINDOW]
            v = np.where((v >= 32) & (v < 127), v - 30, 1)
            lo = CONTEXT - a
            v = v[: WINDOW - lo]
            x[i, lo : lo + len(v)] = v
        return x

    def forward(self, x: np.ndarray, cache: dict | None = None) -> np.ndarray:
        e = self.p["embed"][x]
        pooled = []
        for w in self.WIDTHS:
            n = x.shape[1] - w + 1
            cols = np.concatenate([e[:, k : k + n] for k in range(w)], axis=2)
            a = np.maximum(cols @ self.p[f"conv{w}"] + self.p[f"shift{w}"], 0)
            top = a.argmax(axis=1)
            pooled.append(np.take_along_axis(a, top[:, None, :], axis=1)[:, 0])
            if cache is not None:
                cache[w] = (cols, top)
        h = np.concatenate(pooled, axis=1)
        if cache is not None:
            cache["h"] = h
        return h @ self.p["out"] + self.p["bias"][0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        cache: dict = {}
        z = self.forward(x, cache)
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y).astype(np.float32) / len(y)
        g = {"out": cache["h"].T @ d, "bias": np.array([d.sum()], np.float32), "embed": np.zeros_like(self.p["embed"])}
        dh = d[:, None] * self.p["out"][None]
        rows = np.arange(len(x))[:, None]
        for j, w in enumerate(self.WIDTHS):
            cols, top = cache[w]
            da = dh[:, j * self.FILTERS : (j + 1) * self.FILTERS] * (cache["h"][:, j * self.FILTERS : (j + 1) * self.FILTERS] > 0)
            picked = cols[rows, top]
            g[f"conv{w}"] = np.einsum("nfc,nf->cf", picked, da)
            g[f"shift{w}"] = da.sum(axis=0)
            back = np.einsum("cf,nf->nfc", self.p[f"conv{w}"], da)
            for k in range(w):
                np.add.at(g["embed"], x[rows, top + k], back[:, :, k * self.DIM : (k + 1) * self.DIM])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.003, steps: int = 400, seed: int = 11) -> None:
        """Adam steps: ``epochs`` times over the rows, ``steps`` at least (few rows are not seen often enough otherwise)."""
        g = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(max(epochs, -(-steps * batch // len(x)))):
            order = g.permutation(len(x))
            for lo in range(0, len(x), batch):
                pick = order[lo : lo + batch]
                t += 1
                for k, d in self.gradients(x[pick], y[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    s[k] = 0.99 * s[k] + 0.01 * d * d
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)

    def calibrate(self, x: np.ndarray, y: np.ndarray, views: list[np.ndarray], recall: float) -> None:
        """Platt scaling, then the highest threshold with that recall in each view of the positives."""
        self.platt(self.forward(x), y)
        self.threshold = min(recall_threshold(self.probability(v), recall) for v in views)

    def platt(self, z: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> None:
        """Slope and offset of the scores ``z`` (each ``n`` times) by gradient steps."""
        a, b = 1.0, 0.0
        for _ in range(300):
            d = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - y
            a -= 0.05 * float(np.average(d * z, weights=n))
            b -= 0.5 * float(np.average(d, weights=n))
        self.slope, self.offset = a, b

    def weights(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, weights) -> "CharCNN":
        at = 0
        for k, v in self.p.items():
            self.p[k] = np.asarray(weights[at : at + v.size], np.float32).reshape(v.shape)
            at += v.size
        return self

    def scores(self, rows: list) -> np.ndarray:
        """Probability of each candidate (context, at, length): the highest over the windows of its run."""
        out = np.zeros(len(rows), np.float32)
        pending = ((i, c, a) for i, r in enumerate(rows) for c, a in windows(r["context"], r["at"], r["length"]))
        while part := list(islice(pending, 512)):
            np.maximum.at(out, [i for i, _, _ in part], self.probability(self.encode([c for _, c, _ in part], [a for _, _, a in part])).astype(np.float32))
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.forward(x) + self.offset, -30, 30)))


def candidates(found: DataFrame) -> DataFrame:
    """context, at, length, label and a hash of all different candidates."""
    c = found.select(F.explode("findings").alias("f")).where("f.kind = 'cnn'").select("f.context", "f.at", (F.col("f.end") - F.col("f.start")).alias("length"), "f.label")
    return c.where("label != 2").distinct().withColumn("h", F.xxhash64("context", "at"))


def sample(found: DataFrame) -> list:
    """Of each label the ``TRAIN_PER_CLASS`` first candidates by hash. Nothing is learnt from them as such: ``dealt`` puts them on both sides
    where the hash alone leaves a side without a class (of a few candidates then)."""
    c = candidates(found)
    return [r for k in (0, 1) for r in c.where(F.col("label") == k).orderBy("h", "context", "at", "length").limit(TRAIN_PER_CLASS).collect()]


def held_out(rows: list) -> np.ndarray:
    """Mask of the rows for calibration: a quarter by hash, or where that leaves a side without a class every second
    of a class's keys. Rows of one (context, at) are on one side."""
    held = np.array([r["h"] % 4 == 0 for r in rows], bool)
    y = np.array([r["label"] for r in rows])
    if any(len(set(y[m].tolist())) < 2 for m in (held, ~held)):
        side: dict = {}
        for k in (1, 0):
            own = [r for r in rows if r["label"] == k]
            given = sum(side.get((r["context"], r["at"]), False) for r in own)
            for i, r in enumerate(r for r in own if (r["context"], r["at"]) not in side):
                side[r["context"], r["at"]] = (i + given) % 2 == 0
        held = np.array([side[r["context"], r["at"]] for r in rows], bool)
    return held


def recall_threshold(p: np.ndarray, recall: float) -> float:
    """The highest threshold that this share of the scores reaches (less the rounding of scores between batches)."""
    p = np.sort(p)
    return float(p[len(p) - int(np.ceil(recall * len(p) - 1e-9))]) - 1e-6


def elsewhere(positive: list, others: list) -> list[dict]:
    """Each positive's characters between those around one of ``others``."""
    out = []
    for i, r in enumerate(positive if others else []):
        o = others[i % len(others)]
        left, right = o["context"][: o["at"]], o["context"][o["at"] + o["length"] :]
        out.append({"context": left + r["context"][r["at"] : r["at"] + r["length"]] + right, "at": o["at"], "length": r["length"]})
    return out


def _codes(rows: list) -> np.ndarray:
    """One window of each candidate; of a long one any of its windows, by hash."""
    picked = []
    for r in rows:
        w = list(windows(r["context"], r["at"], r["length"]))
        picked.append(w[zlib.crc32(r["context"].encode("utf-8", "replace")) % len(w)])
    return CharCNN.encode([c for c, _ in picked], [a for _, a in picked])


def dealt(found: DataFrame) -> tuple[DataFrame, int, bool] | None:
    """All different candidates with the side they are on (``held`` for calibration) and their part, the number of parts, and whether
    there are enough to judge the unlabelled ones. None if a class is missing on a side."""
    c = tb.materialized(candidates(found), "secret-candidates")
    held = F.col("h") % 4 == 0
    seen = c.groupBy("label", held.alias("held")).count().collect()
    n = {k: sum(r["count"] for r in seen if r["label"] == k) for k in (0, 1)}
    if not all(n.values()):
        return None
    if len(seen) < 4:
        few = sample(found)
        side = {r["h"]: bool(m) for r, m in zip(few, held_out(few))}
        held = F.when(F.col("h").isin(list(side)), F.col("h").isin([h for h, m in side.items() if m])).otherwise(held)
        if c.select("label", held.alias("held")).distinct().count() < 4:
            return None
    parts = -(-max(n.values()) // TRAIN_PER_CLASS)
    copies = {k: min(parts, -(-PART_LEAST * parts // n[k])) for k in (0, 1)}
    copy = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 1, copies[1] - 1).otherwise(copies[0] - 1)))
    rows = c.select("*", held.alias("held"), copy.alias("copy"))
    part = F.pmod(F.pmod(F.xxhash64(F.lit(5), "h"), F.lit(parts)) + F.col("copy"), F.lit(parts)).cast("int")
    return rows.select("context", "at", "length", "label", "h", "held", F.lit(True).alias("sure"), part.alias("part")), parts, min(n.values()) >= 4


def _by_part(rows: DataFrame, run, schema: str) -> DataFrame:
    """What ``run`` (rows of a part in order -> dicts) makes of each part."""
    names = [f.split()[0] for f in schema.split(", ")]

    def one(table: pa.Table) -> pa.Table:
        given = sorted(table.to_pylist(), key=lambda r: (r["held"], r["h"], r["context"], r["at"], r["length"]))
        out = list(run(given))
        types = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<float>": pa.list_(pa.float32())}
        return pa.table({k: pa.array([r[k] for r in out], types[f.split()[1]]) for k, f in zip(names, schema.split(", "))})

    return rows.groupBy("part").applyInArrow(one, schema)


def _class(given: list, label: int, held: bool | None = None) -> list:
    return [r for r in given if r["label"] == label and held in (None, r["held"])]


def _halves(rows: list, parts: int) -> tuple[list, list]:
    """Every second row; the copies of a row in several parts have one half."""
    if parts == 1:
        return rows[::2], rows[1::2]
    return [r for r in rows if not r["h"] >> 8 & 1], [r for r in rows if r["h"] >> 8 & 1]


def _fitted(rows: DataFrame, parts: int, sets, nets: int) -> list[CharCNN]:
    """``nets`` networks fitted on what ``sets`` names of a part's rows: for each the positives, the unlabelled candidates that lend
    their surroundings, and the negatives."""
    start = [CharCNN().weights()] * nets
    rounds = 1 if parts == 1 else ROUNDS

    for turn in range(rounds):

        def fit(given):
            for k, (positive, others, negative) in enumerate(sets(given)):
                x = np.concatenate([_codes(positive), _codes(elsewhere(positive, others)), _codes(negative)])
                if len(x):
                    net = CharCNN().load(start[k])
                    y = (np.arange(len(x)) < len(x) - len(negative)).astype(np.float32)
                    net.fit(x, y, epochs=-(-6 // rounds), steps=-(-400 // rounds), seed=11 + turn)
                    yield {"net": k, "n": len(x), "weights": net.weights()}

        found = _by_part(rows, fit, "net int, n long, weights array<float>").select("net", "n", F.posexplode("weights").alias("pos", "w"))
        mean = found.groupBy("net", "pos").agg((F.sum(F.col("n") * F.col("w").cast("double")) / F.sum("n")).alias("w")).collect()
        for k in {r["net"] for r in mean}:
            start[k] = np.array([r["w"] for r in sorted((r for r in mean if r["net"] == k), key=lambda r: r["pos"])])
    return [CharCNN().load(w) for w in start]


def _score_rows(view: int, scores: np.ndarray):
    """Scores as the whole numbers of their bits, which sort alike (they are not negative)."""
    return ({"view": view, "bits": b} for b in np.asarray(scores, np.float32).view(np.int32).tolist())


def recall_bars(scores: DataFrame, recall: float) -> dict[int, float]:
    """``recall_threshold`` of the scores (view, bits) of each view: a histogram by their upper bits, and one inside the cell met."""
    cell = F.shiftright("bits", 14)
    upper = scores.groupBy("view", cell.alias("cell")).count().collect()
    met = {}
    for view in {r["view"] for r in upper}:
        own = sorted((r["cell"], r["count"]) for r in upper if r["view"] == view)
        n = sum(m for _, m in own)
        left = n - int(np.ceil(recall * n - 1e-9))
        for at, m in own:
            if left < m:
                met[view] = (at, left)
                break
            left -= m
    bars = {}
    for view, (at, left) in met.items():
        for r in scores.where((F.col("view") == view) & (cell == at)).groupBy("bits").count().orderBy("bits").collect():
            if left < r["count"]:
                bars[view] = float(np.array([r["bits"]], np.int32).view(np.float32)[0]) - 1e-6
                break
            left -= r["count"]
    return bars


def sure_negatives(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` with ``sure``: whether an unlabelled candidate scores below the recall quantile of the positives in their surroundings, by a
    network that was fitted on the other half of both."""
    halves = lambda given: list(zip(_halves(_class(given, 1), parts), _halves(_class(given, 0), parts)))
    nets = _fitted(rows, parts, lambda given: [(p, o, o) for p, o in reversed(halves(given))], 2)

    def shown(given):
        for k, (positive, rest) in enumerate(halves(given)):
            yield from _score_rows(k, nets[k].scores(elsewhere(positive, rest)))

    bars = recall_bars(tb.materialized(_by_part(rows, shown, "view int, bits int"), "secret-scores"), RECALL)

    def judge(given):
        yield from _class(given, 1)
        for k, (_, rest) in enumerate(halves(given)):
            for r, score in zip(rest, nets[k].scores(rest)):
                yield {**r, "sure": bool(score < bars.get(k, 2.0))}

    names = {"context": "string", "at": "int", "length": "int", "label": "int", "h": "long", "held": "boolean", "sure": "boolean", "part": "int"}
    return tb.materialized(_by_part(rows, judge, ", ".join(f"{k} {t}" for k, t in names.items())), "secret-judged")


def train(found: DataFrame) -> CharCNN | None:
    """Fit and calibrate on all different labelled candidates; None if a class is missing."""
    given = dealt(found)
    if given is None:
        return None
    rows, parts, enough = given
    sure = (True, True)  # by side: whether there are sure negatives (if not, all unlabelled ones count)
    if enough:
        rows = sure_negatives(rows, parts)
        left = {r["held"] for r in rows.where("label = 0 and sure").select("held").distinct().collect()}
        sure = (False in left, True in left)
    negatives = lambda given, held: [r for r in _class(given, 0, held) if r["sure"] or not sure[held]]
    (net,) = _fitted(rows, parts, lambda given: [(_class(given, 1, False), _class(given, 0, False), negatives(given, False))], 1)
    kept = rows.where("held")
    views = lambda given: [_class(given, 1), elsewhere(_class(given, 1), _class(given, 0))]

    def logits(given):
        for y, part in ((1, views(given)[0]), (1, views(given)[1]), (0, negatives(given, True))):
            for lo in range(0, len(part), 512):
                z = net.forward(_codes(part[lo : lo + 512]))
                yield from ({"y": y, "cell": c} for c in np.rint(np.clip(z, -32, 32) * 256).astype(int).tolist())

    cells = _by_part(kept, logits, "y int, cell int").groupBy("y", "cell").count().orderBy("y", "cell").collect()
    net.platt(*(np.array([f(r) for r in cells], float) for f in (lambda r: r["cell"] / 256, lambda r: r["y"], lambda r: r["count"])))

    def shown(given):
        for k, view in enumerate(views(given)):
            yield from _score_rows(k, net.scores(view))

    bars = recall_bars(tb.materialized(_by_part(kept, shown, "view int, bits int"), "secret-scores"), RECALL)
    net.threshold = min(bars.values())  # by whole candidates, as they are judged
    return net


def found_by(net: CharCNN | None, candidates: list[dict]) -> list[bool]:
    """Which candidates are secrets. Without a network only those beside a base span count as such."""
    if net is None:
        return [f["label"] == REST for f in candidates]
    rows = [{"context": f["context"], "at": f["at"], "length": f["end"] - f["start"]} for f in candidates]
    return (net.scores(rows) >= net.threshold).tolist()


def spans(found: DataFrame, net: CharCNN | None) -> DataFrame:
    """doc_id, base (list of kind, start, end) and all (the base spans and the network's) of each row."""

    def judge(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            items = batch.column("findings").to_pylist()
            cand = [(i, f) for i, fs in enumerate(items) for f in fs if f["kind"] == "cnn" and f["label"] != 1]
            more: dict[int, list] = {}
            for (i, f), yes in zip(cand, found_by(net, [f for _, f in cand])):
                if yes:
                    more.setdefault(i, []).append({"kind": "cnn", "start": f["start"], "end": f["end"]})
            base = [[{k: f[k] for k in ("kind", "start", "end")} for f in fs if f["kind"] != "cnn"] for fs in items]
            every = [sorted(b + more.get(i, []), key=lambda s: (s["start"], KINDS.index(s["kind"]))) for i, b in enumerate(base)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, kind), pa.array(every, kind)], ["doc_id", "base", "all"])

    one = "array<struct<kind:string,start:int,end:int>>"
    return found.mapInArrow(judge, f"doc_id long, base {one}, `all` {one}")


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, base, all: span lists of every row. The texts are read once; training and judging
    work on the findings table."""
    found = tb.materialized(findings(docs), "secret-findings")
    return spans(found, train(found))


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns, from the span lists."""
    text = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text("base"), 256).alias("base_sha256"), text("all").alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span (merged where they overlap) replaced by ``mask``; all columns and rows kept."""
    net = train(tb.materialized(findings(docs), "secret-findings"))
    names, schema = docs.columns, docs.schema
    at = names.index("text")

    def mask_out(batches):
        for batch, _, _ in tb.text_slices(batches):
            texts = batch.column(at).to_pylist()
            ids = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), batch.column(at)], ["doc_id", "text"])
            hits = {}
            for f in _extract([ids]):
                for i, fs in zip(f.column("doc_id").to_pylist(), f.column("findings").to_pylist()):
                    keep = [(x["start"], x["end"]) for x in fs if x["kind"] != "cnn"]
                    cand = [x for x in fs if x["kind"] == "cnn" and x["label"] != 1]
                    keep += [(x["start"], x["end"]) for x, yes in zip(cand, found_by(net, cand)) if yes]
                    if keep:
                        hits[i] = sorted(keep)
            for i, spans_ in hits.items():
                out, last = [], 0
                for s, e in spans_:
                    if s >= last:
                        out += [texts[i][last:s], mask]
                    last = max(last, e)
                texts[i] = "".join(out) + texts[i][last:]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return tb.bounded_batches(docs).mapInArrow(mask_out, schema)
