"""Byte-level BPE: backtracking encoder over a trie automaton, offset-table decoder.

Method. Texts are split by the vocabulary's pre-token pattern with array operations over code
points. The distinct pre-tokens of a slice are encoded in lockstep: at every position the goto
function of a trie of all tokens (the Aho-Corasick automaton without failure links, as matches are anchored
at their start) gives the longest token; the backtracking encoder takes it if it is compatible
with the token before it, else the next shorter prefix token, else it steps back and marks the position
as dead. Each position is marked dead at most once, so the work is linear, and the result is exactly that of
applying the merges by rank. Compatibility of a pair comes from the merge and split tables.
Decoding gathers token bytes from one table of offsets.

Vocabulary: a tokenizers-library JSON file of a byte-level BPE (path is a parameter; read on each
worker once). Strings of special tokens in a text become their ids, as the library does.

Defined results: null and empty texts have no tokens; null ids, repeated rows and ties are kept, row by row.
A text without white space is one long pre-token: correct, with one array step a token.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm import textbuf as tb

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: bytes of text encoded at once: the array steps of a slice are as many as its longest word has tokens, however many words it has
SLICE = 1 << 19
# fixed values: White_Space code points, contractions of the pattern
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
APOSTROPHE = 0x27

_CLASS: list[np.ndarray] = []


def _classes() -> np.ndarray:
    if not _CLASS:
        import regex

        t = np.full(sys.maxunicode + 1, OTHER, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
        for kind, what in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
            t[np.frombuffer("".join(regex.findall(what, every)).encode("utf-32-le"), np.uint32)] = kind
        t[WHITE] = SPACE
        _CLASS.append(t)
    return _CLASS[0]


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others for the characters from U+0100 on, in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class HashTable:
    """Open-addressed table of non-negative int64 keys to int32 values, with array look-ups."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 0):
        self.bits = bits or max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.add(keys, values)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Insert distinct keys that are not in the table yet."""
        size = 1 << self.bits
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] == -1
            put = left[free]
            self.keys[slot[put]] = keys[put]
            self.values[slot[put]] = values[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where a key is missing."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.int32(-1))
        left = np.flatnonzero((found != keys) & (found != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found != -1)]
        return out


#: bytes of a word that its key holds as they are
SHORT = 7
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(SHORT + 1)], np.uint64)


def word_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A key of each word: up to SHORT bytes the bytes and their number themselves, below 2^60; longer words get 60 bits of
    a hash above that, so equal keys of long words do not prove equal words."""
    n = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[start]).view("<u8").ravel()
    short = np.minimum(n, SHORT)
    key = (eight & _KEEP[short]) | (short.astype(np.uint64) << np.uint64(56))
    long = np.flatnonzero(n > SHORT)
    key[long] = (tb.run_hashes(data, start[long], end[long]) >> np.uint64(4)) | np.uint64(1 << 60)
    return key.astype(np.int64)


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of runs, one after the other, and the offsets of the runs in them."""
    off = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    return data[np.repeat(start - off[:-1], length) + np.arange(off[-1])], off


class Growing:
    """An array to whose end others are added."""

    def __init__(self, dtype, size: int = 1 << 12):
        self.a, self.n = np.zeros(size, dtype), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.a):
            grown = np.zeros(max(2 * len(self.a), self.n + len(more)), self.a.dtype)
            grown[: self.n] = self.a[: self.n]
            self.a = grown
        self.a[self.n : self.n + len(more)] = more
        self.n += len(more)


class WordCache:
    """Ids of the words seen by a worker, by ``word_keys``. The bytes of long words are kept and compared, so
    no two words share ids. Starts anew with more than WORDS words or BYTES bytes of long ones."""

    WORDS, BYTES = 1 << 19, 1 << 25

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.int64)
        self.table = HashTable(none, none.astype(np.int32), 14)
        self.ids, self.bytes = Growing(np.int32), Growing(np.uint8)
        self.start, self.size = Growing(np.int64), Growing(np.int32)
        #: the bytes of a long word; 0 of them for a short one
        self.at, self.length = Growing(np.int64), Growing(np.int64)
        self.n = 0

    def full(self) -> bool:
        return self.n > self.WORDS or self.bytes.n > self.BYTES

    def find(self, key: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for words not seen (or whose key belongs to other bytes)."""
        word = self.table.get(key).astype(np.int64)
        n = end - start
        long = np.flatnonzero((n > SHORT) & (word >= 0))
        if len(long):
            of = word[long]
            word[long[self.length.a[of] != n[long]]] = -1
            long = long[word[long] >= 0]
            own, off = gathered(data, start[long], n[long])
            kept, _ = gathered(self.bytes.a, self.at.a[word[long]], n[long])
            if len(long):
                word[long[np.logical_or.reduceat(own != kept, off[:-1])]] = -1
        return word

    def put(self, keys: np.ndarray, data: np.ndarray, off: np.ndarray, ids: np.ndarray, id_off: np.ndarray) -> np.ndarray:
        """Add words (bytes ``data`` by ``off``) with their ids; returns their numbers. A word whose key is
        taken gets a number, too, but is not found again."""
        k = len(keys)
        _, first = np.unique(keys, return_index=True)
        first = first[self.table.get(keys[first]) < 0]
        if (self.n + k) * 2 > len(self.table.keys):
            old = self.table
            live = old.keys >= 0
            self.table = HashTable(old.keys[live], old.values[live], ((self.n + k) * 4).bit_length())
        number = np.arange(self.n, self.n + k, dtype=np.int64)
        self.table.add(keys[first], number[first].astype(np.int32))
        n = np.diff(off)
        n[n <= SHORT] = 0
        kept, kept_off = gathered(data, off[:-1], n)
        self.start.add(self.ids.n + id_off[:-1])
        self.size.add(np.diff(id_off))
        self.at.add(self.bytes.n + kept_off[:-1])
        self.length.add(n)
        self.ids.add(ids)
        self.bytes.add(kept)
        self.n += k
        return number


class Vocabulary:
    """Ranks, trie, prefix, pair and split tables of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError(f"{path}: not a byte-level BPE vocabulary that splits by its pattern")
        symbol = byte_symbols()
        text = {k: bytes(symbol[c] for c in k) for k in model["vocab"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # work in rank order: the 256 bytes, then the merges
        ids = [0] * 256
        for k, v in text.items():
            if len(v) == 1:
                ids[v[0]] = model["vocab"][k]
        token = [bytes([b]) for b in range(256)] + [text[a + b] for a, b in pairs]
        rank = {t: i for i, t in enumerate(token)}
        self.id_of = np.array(ids + [model["vocab"][a + b] for a, b in pairs], np.int64)
        left = np.array([rank[text[a]] for a, _ in pairs], np.int64)
        right = np.array([rank[text[b]] for _, b in pairs], np.int64)
        own = np.arange(256, dtype=np.int64)
        self.left, self.right = np.concatenate([own, left]), np.concatenate([own, right])
        self.n = len(token)
        self.pair = HashTable(left * self.n + right, np.arange(256, self.n, dtype=np.int32))
        self.length = np.array([len(t) for t in token], np.int64)
        self._trie(token, rank)
        self.words = WordCache()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        by_id = [b""] * size
        for k, v in model["vocab"].items():
            by_id[v] = text[k]
        for k, v in self.special.items():
            by_id[v] = k.encode()
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(b) for b in by_id])]).astype(np.int64)

    def _trie(self, token: list[bytes], rank: dict[bytes, int]) -> None:
        node: dict[bytes, int] = {b"": 0}
        for t in token:
            for k in range(1, len(t) + 1):
                node.setdefault(t[:k], len(node))
        keys = np.array([node[p[:-1]] * 256 + p[-1] for p in node if p], np.int64)
        self.goto = HashTable(keys, np.array([v for p, v in node.items() if p], np.int32))
        self.token_at = np.full(len(node), -1, np.int32)
        for t, i in rank.items():
            self.token_at[node[t]] = i
        shorter = np.full(len(token), -1, np.int32)
        for t, i in rank.items():
            for k in range(len(t) - 1, 0, -1):
                if t[:k] in rank:
                    shorter[i] = rank[t[:k]]
                    break
        self.shorter = shorter

    def longest(self, data: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Longest token that starts at each position and ends by ``end`` of that position."""
        best = data.astype(np.int32)
        at = np.arange(len(data), dtype=np.int64)
        node = np.zeros(len(data), np.int64)
        depth = 0
        while len(at):
            node = self.goto.get(node * 256 + data[at + depth]).astype(np.int64)
            live = node >= 0
            at, node = at[live], node[live]
            t = self.token_at[node]
            hit = t >= 0
            best[at[hit]] = t[hit]
            depth += 1
            live = at + depth < end[at]
            at, node = at[live], node[live]
        return best

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging by rank keeps tokens a, b side by side: no merge across the border comes
        before both are complete. Undo the later-built of the two and look at the pair at the border."""
        ok = np.ones(len(a), bool)
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        open_ = np.arange(len(a))
        while len(open_):
            x, y, top = a[open_], b[open_], limit[open_]
            joined = self.pair.get(x * self.n + y).astype(np.int64)
            bad = (joined >= 0) & (joined < top)
            ok[open_[bad]] = False
            # the later-built token is undone first; single bytes cannot be undone
            x_first = ((x > y) & (x >= 256)) | (y < 256)
            done = (x < 256) & (y < 256)
            limit[open_] = np.where(x_first, x, y + 1)
            a[open_] = np.where(x_first, self.right[x], x)
            b[open_] = np.where(x_first, y, self.left[y])
            open_ = open_[~bad & ~done]
        return ok

    def encode_words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ranks, offsets) of words given as consecutive byte ranges that cover ``data``."""
        best = self.longest(data, np.repeat(end, end - start))
        dead = np.zeros(len(data) + 1, bool)
        ended = np.full(len(data) + 1, -1, np.int32)
        pos = start.astype(np.int64).copy()
        token = best[pos].copy() if len(pos) else np.zeros(0, np.int32)
        act = np.arange(len(start))
        while len(act):
            p, t = pos[act], token[act]
            nxt = p + self.length[t]
            inside = p > start[act]
            before = np.where(inside, ended[p], -1)
            good = ~dead[nxt]
            test = np.flatnonzero(good & inside)
            if len(test):
                good[test] = self.compatible(before[test], t[test])
            g = act[good]
            ended[nxt[good]] = t[good]
            pos[g] = nxt[good]
            more = nxt[good] < end[g]
            token[g[more]] = best[nxt[good][more]]
            worse = self.shorter[t]
            less = ~good & (worse >= 0)
            token[act[less]] = worse[less]
            back = ~good & (worse < 0)
            dead[p[back]] = True
            pos[act[back]] = p[back] - self.length[before[back]]
            token[act[back]] = before[back]
            act = act[pos[act] < end[act]]
        return self._walk(ended, start, end)

    def _walk(self, ended: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read the chosen tokens from each word's end back to its start."""
        words, at, got = [], [], []
        act, p = np.arange(len(start)), end.astype(np.int64).copy()
        step = 0
        while len(act):
            t = ended[p[act]]
            words.append(act)
            got.append(t)
            at.append(np.full(len(act), step))
            p[act] -= self.length[t]
            act = act[p[act] > start[act]]
            step += 1
        if not words:
            return np.zeros(0, np.int64), np.zeros(len(start) + 1, np.int64)
        w, t, s = np.concatenate(words), np.concatenate(got), np.concatenate(at)
        n = np.bincount(w, minlength=len(start))
        off = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        out = np.empty(len(t), np.int64)
        out[off[w + 1] - 1 - s] = t
        return out, off

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts in a slice."""
        raw = bytes(data)
        cuts, special = [], []
        for s, i in self.special.items():
            k = s.encode()
            p = raw.find(k)
            while p >= 0:
                if np.searchsorted(off, p, "right") == np.searchsorted(off, p + len(k) - 1, "right"):
                    special.append((p, p + len(k), i))
                    p = raw.find(k, p + len(k))
                else:
                    p = raw.find(k, p + 1)
        special.sort()
        for a, b, _ in special:
            cuts += [a, b]
        piece = np.unique(np.concatenate([off, np.array(cuts, np.int64)]))
        start = pretokens(data, piece)
        end = np.append(start[1:], len(data)) if len(start) else start
        inside = np.zeros(len(start), bool)
        if special:
            # a special string's own pre-tokens give way to its id
            s_at, s_end, s_id = (np.array(x, np.int64) for x in zip(*special))
            k = np.maximum(np.searchsorted(s_at, start, "right") - 1, 0)
            inside = (start >= s_at[k]) & (start < s_end[k])
        if self.words.full():
            self.words.clear()
        word = np.zeros(len(start), np.int64)
        if len(start):
            key = word_keys(data, start, end)
            word = self.words.find(key, data, start, end)
            new = np.flatnonzero(word < 0)
            if len(new):
                _, first = np.unique(key[new], return_index=True)
                self._learn(key, data, start, end, new[first])
                word[new] = self.words.find(key[new], data, start[new], end[new])
                other = np.flatnonzero(word < 0)  # long words whose key other bytes have
                if len(other):
                    word[other] = self._learn(key, data, start, end, other)
        size = np.where(inside, 0, self.words.size.a[word])
        source = self.words.start.a[word]
        if special:
            head = inside & (start == s_at[k])
            size[head] = 1
        total = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        if total[-1]:
            shift = np.repeat(source - total[:-1], size)
            shift += np.arange(total[-1])
            ids = self.words.ids.a[np.minimum(shift, len(self.words.ids.a) - 1)]
            if special:
                ids[total[:-1][head]] = s_id[k[head]]
        else:
            ids = np.zeros(0, np.int32)
        return ids, total[np.searchsorted(start, off)]

    def _learn(self, key: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Encode these words and keep their ids; returns their numbers."""
        flat, off = gathered(data, start[which], (end - start)[which])
        ranks, id_off = self.encode_words(flat, off[:-1], off[1:])
        return self.words.put(key[which], flat, off, self.id_of[ranks].astype(np.int32), id_off)

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.offset[ids + 1] - self.offset[ids]
        total = np.concatenate([[0], np.cumsum(n)])
        return self.bytes[np.repeat(self.offset[ids] - total[:-1], n) + np.arange(total[-1])].tobytes()


def pretokens(data: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Byte positions where the pattern's matches start, each piece (bounds in ``piece``) on its own.

    The pattern: contractions; a letter, number or other run, each with one leading space; white space
    without its last character if text follows; the rest of the white space."""
    if len(data) == 0:
        return np.zeros(0, np.int64)
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    code = np.frombuffer(bytes(data).decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(code)
    kind = _classes()[code]
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(at, piece)] = True
    edge[0] = edge[n] = True
    first = edge[:-1].copy()
    first[1:] |= kind[1:] != kind[:-1]
    # white space before text: its last character starts a match of its own, or joins the run if it is U+0020
    ends_ws = np.zeros(n, bool)
    ends_ws[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n]
    first[ends_ws] = True
    joins = np.zeros(n, bool)
    joins[1:] = (ends_ws & (code == 0x20))[:-1]
    first[joins] = False
    # contractions: an apostrophe that begins a match, and the letters after it
    head = np.flatnonzero(first & (code == APOSTROPHE))
    if len(head):
        # later positions of the run of others: only a run of one apostrophe is followed by a letter
        text = code
        for c in CONTRACTIONS:
            k = len(c)
            h = head[head + k < n]
            for j, ch in enumerate(c):
                h = h[(text[h + 1 + j] == ord(ch)) & ~edge[h + 1 + j]]
            first[h + 1] = False
            after = h + 1 + k
            after = after[after < n]
            # what follows begins a match unless a space already joined to it does
            joined_before = kind[after - 1] == SPACE
            first[after[~joined_before]] = True
    return at[first]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One table set a worker process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (list of int) of every row."""

    def run(batches):
        v = vocabulary(path)
        for rows, data, off in tb.text_slices(batches, SLICE):
            ids, o = v.encode(data, off)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return tb.id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, text of (doc_id, ids); bytes that are not UTF-8 become U+FFFD."""

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            texts = [v.decode(np.array(x.as_py() or [], np.int64)).decode("utf-8", "replace") for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode each text, decode its ids, digest both."""

    def run(batches):
        v = vocabulary(path)
        for rows, data, off in tb.text_slices(batches, SLICE):
            ids, o = v.encode(data, off)
            enc, dec = [], []
            for a, b in zip(o[:-1], o[1:]):
                own = ids[a:b]
                enc.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                dec.append(hashlib.sha256(v.decode(own).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(o), pa.int64()), pa.array(enc, pa.string()), pa.array(dec, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return tb.id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
