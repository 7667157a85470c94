"""URL filter: bit-parallel wildcard automaton over canonical URLs.

Method. All glob rules are packed into the bits of as many 64-bit words as they need. A Shift-And step moves every
pattern at once: ``state = ((state << 1) | starts) & mask[character]``, where a ``*`` keeps its bit set on any
character (its state bit loops) and is skipped for free (an epsilon step by one addition of the star bits).
The automaton reads one character of all URLs of a block at a time; after the last one the accepting bits name the rules that fit.
Host-and-path rules compile to globs over ``.host``, a separator byte that no UTF-8 text holds, ``path``: a rule for ``com`` and
``/`` is ``*.com`` + separator + ``/*``. Their characters are literal. Of the rules that fit, the longest decides (of rules with the same host and
path the first); URLs that none fits are judged by the method's own block globs (host glob, path glob), run by the same
automaton over the canonical host: without user, port and final dot.

Rules and globs are parameters; ``rules_of`` reads rules from a table of at most ``MAX_RULES`` rows and ``MAX_RULE_BYTES`` (an error
beyond: the automaton goes to every task).

Defined results: null urls and urls without ``://`` have empty host and path and fit no rule; the method's globs
need a host, so such rows are allowed; any character may stand in a url, NUL and line ends too; repeated rows and null ids are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import textbuf as tb

# fixed values: the rules (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: words that a label of a blocked host begins with, or ends with, beside a hyphen
FIRST_WORDS = ("spam", "cheap", "casino", "warez", "replica", "payday")
LAST_WORDS = ("farm", "pills", "casino", "spam", "warez", "replicas", "loans")
#: the method's own verdicts: (glob over ``.host``, glob over the path)
BLOCK_GLOBS = tuple((f"*.{w}-*", "*") for w in FIRST_WORDS) + tuple((f"*-{w}.*", "*") for w in LAST_WORDS)
SEPARATOR = 0xFF
STAR = 256
MAX_RULES, MAX_RULE_BYTES = 20_000, 1 << 20
#: state words of a block of URLs
BLOCK_WORDS = 1 << 21


def glob(text: str) -> list[int]:
    """Bytes and STAR of a text in which ``*`` stands for anything."""
    return [STAR if c == ord("*") else c for c in text.encode()]


class ShiftAnd:
    """Globs (lists of bytes and STAR) over bytes, matched against whole strings."""

    def __init__(self, globs: list[list[int]]):
        self.n = len(globs)
        bits = sum(len(g) + 1 for g in globs)
        self.words = max(1, (bits + 63) // 64)
        mask = np.zeros((256, self.words), np.uint64)
        loop, star, start = (np.zeros(self.words, np.uint64) for _ in range(3))
        put = lambda a, b: a.__setitem__(b >> 6, a[b >> 6] | np.uint64(1 << (b & 63)))
        at, self.accept = 0, []
        for g in globs:
            # bit k of a glob: its first k characters are read
            put(start, at)
            for k, c in enumerate(g):
                if c == STAR:
                    put(loop, at + k + 1)
                    put(star, at + k)
                else:
                    put(mask[c], at + k + 1)
            self.accept.append(at + len(g))
            at += len(g) + 1
        self.mask, self.loop, self.star, self.start = mask, loop, star, start

    def _shift(self, s: np.ndarray) -> np.ndarray:
        out = s << np.uint64(1)
        out[:, 1:] |= s[:, :-1] >> np.uint64(63)
        return out

    def _skip(self, s: np.ndarray) -> np.ndarray:
        """A star may stand for nothing: from before it to after it, as often as stars follow each other."""
        while True:
            more = s | self._shift(s & self.star)
            if (more == s).all():
                return s
            s = more

    def match(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """rows x globs: whether the whole string fits."""
        n = np.diff(off)
        out = np.zeros((len(n), self.n), bool)
        order = np.argsort(-n, kind="stable")
        state = self._skip(np.tile(self.start, (len(n), 1)))
        at = off[:-1][order]
        length = n[order]
        for k in range(int(length[0]) if len(n) else 0):
            live = int(np.searchsorted(-length, -k, "left"))
            s = state[:live]
            c = data[at[:live] + k]
            state[:live] = self._skip((self._shift(s) & self.mask[c]) | (s & self.loop))
        for j, b in enumerate(self.accept):
            out[order, j] = (state[:, b >> 6] >> np.uint64(b & 63)) & np.uint64(1) == 1
        return out


def host_path(url):
    """(host, path) columns of a url column."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    before = F.regexp_extract(rest, r"^([^?#]*)", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(before, r"^[^/]*([\s\S]*)\z", 1)
    return host, path


def canonical_host(host: str) -> str:
    """The host without user, port and final dot."""
    return re.sub(r":[0-9]*\Z", "", host.rpartition("@")[2]).removesuffix(".")


def rules_of(table: DataFrame) -> list[tuple[str, str, str]]:
    """(verdict, host, path) of a rule table with these columns, different ones in order; a bounded number of them."""
    rules = table.select(*(F.col(c).cast("string").alias(c) for c in ("verdict", "host", "path"))).distinct()
    unfit = ~F.col("verdict").isin("allow", "block") | ~F.startswith("path", F.lit("/")) | (F.col("host") == "")
    n, size, bad = rules.agg(F.count(F.lit(1)), F.sum(F.octet_length("host") + F.octet_length("path")), F.count_if(F.coalesce(unfit, F.lit(True)))).first()
    if bad:
        raise ValueError(f"{bad} rules without a verdict of allow or block, a host, or a path that begins with /")
    if n > MAX_RULES or (size or 0) > MAX_RULE_BYTES:
        raise ValueError(f"{n} rules of {size} bytes: more than {MAX_RULES} or {MAX_RULE_BYTES}")
    return sorted((r.verdict, r.host, r.path) for r in rules.collect())


def _judge(rules, block_globs):
    """Longest rule first: by length of host and path, then of the host."""
    ranked = sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1])), reverse=True)
    own = [[*glob(h), SEPARATOR, *glob(p)] for h, p in block_globs]
    literal = [[STAR, *f".{h}".encode(), SEPARATOR, *p.encode(), STAR] for _, h, p in ranked]
    everything, only_own = ShiftAnd(literal + own), ShiftAnd(own)
    names = pa.array([f"{h}{p}" for _, h, p in ranked] + [None], pa.string())
    verdicts = np.array([v for v, _, _ in ranked] + ["allow"])

    def fits(auto, hosts, paths):
        text = [b".%s%c%s" % (h.encode(), SEPARATOR, p.encode()) if h else b"" for h, p in zip(hosts, paths)]
        off = np.concatenate([[0], np.cumsum([len(t) for t in text])]).astype(np.int64)
        return auto.match(np.frombuffer(b"".join(text), np.uint8), off)

    def judged(hosts, paths):
        found = fits(everything, hosts, paths)
        by_rule, by_glob = found[:, : len(ranked)], found[:, len(ranked) :].any(axis=1)
        names_ = [canonical_host(h) for h in hosts]
        odd = [i for i, (h, c) in enumerate(zip(hosts, names_)) if h != c]
        if odd:
            by_glob[odd] = fits(only_own, [names_[i] for i in odd], [paths[i] for i in odd]).any(axis=1)
        none = ~by_rule.any(axis=1)
        best = np.where(none, len(ranked), by_rule.argmax(axis=1) if len(ranked) else 0)
        return best, np.where(none, np.where(by_glob, "block", "allow"), verdicts[best])

    def run(batches):
        step = max(1, BLOCK_WORDS // everything.words)
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                best, verdict = judged(part.column("host").to_pylist(), part.column("path").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("host"), part.column("path"), names.take(pa.array(best)), pa.array(verdict.tolist(), pa.string())], ["page_id", "host", "path", "rule", "verdict"]
                )

    return run


def judge_urls(pages: DataFrame, rules=RULES, block_globs=BLOCK_GLOBS) -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    url = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = host_path(F.col("url"))
    return url.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(_judge(rules, block_globs), "page_id long, host string, path string, rule string, verdict string")
