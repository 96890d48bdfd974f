"""Substring dedup by windows of words, with a count-min prefilter.

First pass: every group of documents sketches its windows: two rows of counters, of which it sends those that are not
zero, cut by counter range. Receivers add the sketches up, so a counter is never below the true count of a window in it,
and tell each sender which of its own counters reached two. Second pass: only windows whose both counters did are sent,
by a 96-bit hash with their place, each different window once a group; receivers group them exactly and answer whether
the sender holds the first. Third pass: all other copies are removed. No window that repeats is lost, a window's copies
within a group travel as one, and no task or driver holds the whole sketch.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.blobs import dealt, hashed_words, join_blobs, ordered, pack, pack_bits, pack_sorted, sections, sizing, split_blobs, unpack, unpack_bits, unpack_sorted, window_hashes
from tidings.llm.common import mix64

WINDOW = 20  # words
ROWS = 2  # of the sketch
SPREAD = 8  # counters for each window, about
SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
MESSAGE = "to int, kind string, at int, data binary"
ANSWER = "_group int, kind string, at int, data binary"


class Windows:
    """The windows of a group: one after another in order, with where each document's words start."""

    def __init__(self, pdf: pd.DataFrame, size: int):
        self.ids, self.ties, self.texts, self.null = ordered(pdf)
        flat, self.n_words = hashed_words(self.texts)
        self.first = np.concatenate([[0], np.cumsum(self.n_words)])
        inside = np.zeros(len(flat), dtype=bool)
        for s, n in zip(self.first, self.n_words):
            inside[s : s + max(0, n - size + 1)] = True
        self.at = np.flatnonzero(inside)
        self.hash = window_hashes(flat, size)[self.at]
        self._flat, self._size, self._check = flat, size, None

    @property
    def check(self) -> np.ndarray:
        """32 more bits of each window, from other hashes of its words."""
        if self._check is None:
            self._check = (window_hashes(mix64(self._flat ^ SEEDS[0]), self._size)[self.at] >> np.uint64(32)).astype(np.uint32)
        return self._check


def counters(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The counter of each window in one row of the sketch."""
    return mix64(hashes ^ SEEDS[row]) >> np.uint64(64 - bits)


def _cuts(values: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Where ascending numbers of `bits` bits pass from one of `parts` equal ranges to the next."""
    bounds = [np.uint64((k << bits) // parts) for k in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(values, np.array(bounds, dtype=np.uint64)), [len(values)]]).astype(np.int64)


def _sketch(bits: int, parts: int, size: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        w, out = Windows(pdf, size), []
        for row in range(ROWS):
            values, n = np.unique(counters(w.hash, row, bits), return_counts=True)
            at = _cuts(values, bits, parts)
            for k in np.flatnonzero(np.diff(at)):
                v, c = values[at[k] : at[k + 1]], np.minimum(n[at[k] : at[k + 1]], 255).astype(np.uint8)
                a, b = pack_sorted(v), pack(c)
                out.append((row * parts + k, "", key[0], len(a).to_bytes(4, "little") + a + b))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _merged_sketch(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Adds up one range of one row; answers each sender which of its counters reached two."""
    parts = []
    for data in pdf["data"]:
        n = int.from_bytes(data[:4], "little")
        parts.append((unpack_sorted(data[4 : 4 + n]), unpack(data[4 + n :])))
    values = np.concatenate([v for v, _ in parts])
    uniques, inverse = np.unique(values, return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate([c for _, c in parts]), minlength=len(uniques))
    hot = (total >= 2)[inverse]
    ends = np.cumsum([len(v) for v, _ in parts])
    return pd.DataFrame({"_group": pdf["at"], "kind": "sketch", "at": key[0], "data": [pack_bits(x) for x in np.split(hot, ends[:-1])]})


def _candidates(w: Windows, answers: dict, bits: int, parts: int) -> np.ndarray:
    """Windows (by index) whose counters all reached two, sorted by hash; equal ones in order of place."""
    hot = np.ones(len(w.hash), dtype=bool)
    for row in range(ROWS):
        values, inverse = np.unique(counters(w.hash, row, bits), return_inverse=True)
        at = _cuts(values, bits, parts)
        flags = np.zeros(len(values), dtype=bool)
        for k in np.flatnonzero(np.diff(at)):
            flags[at[k] : at[k + 1]] = unpack_bits(answers["sketch", row * parts + k])
        hot &= flags[inverse]
    some = np.flatnonzero(hot)
    return some[np.lexsort((w.check[some], w.hash[some]))]


def _sent(w: Windows, some: np.ndarray) -> np.ndarray:
    """Of candidates sorted by hash, which are the first in this group."""
    new = np.ones(len(some), dtype=bool)
    new[1:] = (w.hash[some][1:] != w.hash[some][:-1]) | (w.check[some][1:] != w.check[some][:-1])
    return new


def _exact(bits: int, parts: int, size: int):
    def run(key, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(docs):
            w = Windows(docs, size)
            some = _candidates(w, sections(answers), bits, parts)
            firsts = some[_sent(w, some)]
            h, place = w.hash[firsts], w.at[firsts]
            doc = np.searchsorted(w.first, place, side="right") - 1
            at = _cuts(h, 64, parts)
            for k in np.flatnonzero(np.diff(at)):
                s = slice(at[k], at[k + 1])
                used, local = np.unique(doc[s], return_inverse=True)
                blobs = [pack_sorted(h[s]), pack(w.check[firsts[s]]), pack(local.astype(np.uint32)), pack((place[s] - w.first[doc[s]]).astype(np.uint32)), pack(w.ids[used]), pack(w.ties[used])]
                out.append((k, "", key[0], join_blobs(blobs)))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _merged_exact(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Groups equal windows of all senders; answers each whether it holds the first of each."""
    cols: list[list[np.ndarray]] = [[], [], [], [], []]
    for data in pdf["data"]:
        h, check, local, place, ids, ties = (f(b) for f, b in zip((unpack_sorted, unpack, unpack, unpack, unpack, unpack), split_blobs(data)))
        for c, x in zip(cols, (h, check, ids[local], ties[local], place)):
            c.append(x)
    sizes = [len(x) for x in cols[0]]
    h, check, ids, ties, place = (np.concatenate(c) for c in cols)
    order = np.lexsort((check, h))
    differs = lambda i, j: (h[i] != h[j]) | (check[i] != check[j])
    same = ~differs(order[1:], order[:-1])
    many = np.zeros(len(h), dtype=bool)
    many[1:] |= same
    many[:-1] |= same
    first = np.ones(len(h), dtype=bool)
    some = order[many]
    if len(some):
        some = some[np.lexsort((place[some], ties[some], ids[some], check[some], h[some]))]
        first[some[1:]] = differs(some[1:], some[:-1])
    bits = np.split(first, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"_group": pdf["at"], "kind": "exact", "at": key[0], "data": [pack_bits(x) for x in bits]})


def _removed(w: Windows, answers: dict, bits: int, parts: int, size: int) -> np.ndarray:
    """Which words of the group go: those of every window but the first of its kind."""
    some = _candidates(w, answers, bits, parts)
    sent = _sent(w, some)
    firsts = some[sent]
    at = _cuts(w.hash[firsts], 64, parts)
    keep = np.zeros(len(firsts), dtype=bool)
    for k in np.flatnonzero(np.diff(at)):
        keep[at[k] : at[k + 1]] = unpack_bits(answers["exact", k])
    gone = np.ones(len(some), dtype=bool)
    gone[np.flatnonzero(sent)[keep]] = False
    starts = w.at[some[gone]]
    depth = np.zeros(w.first[-1] + size + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + size, -1)
    return np.cumsum(depth)[: w.first[-1]] > 0


def _finish(bits: int, parts: int, size: int):
    def run(key, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(docs):
            w = Windows(docs, size)
            gone = _removed(w, sections(answers), bits, parts, size)
            for i, t in enumerate(w.texts):
                cut = gone[w.first[i] : w.first[i + 1]]
                words = t.split()
                kept = b" ".join([x for x, c in zip(words, cut) if not c] if cut.any() else words)
                out.append((None if w.null[i] else int(w.ids[i]), int(w.n_words[i]), int(cut.sum()), kept))
        return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"]).astype({"doc_id": "Int64"})

    return run


def dedup_windows(docs: DataFrame, *, size: int = WINDOW, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and `kept` (the words left, joined by one space, as UTF-8) for each row of `docs`.

    A word goes if a window of `size` words around it starts earlier elsewhere too: in a document of smaller id, or
    earlier in the same. Null ids come last; rows of equal id are ordered by a hash of their text, and of fully equal rows
    one, no matter which, counts as the first. Null texts count as empty; texts shorter than a window keep all words; an
    empty table stays empty; texts are read whole, and a very long one makes its group, which one task holds, so much
    larger; other columns are not read.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n, parts = sizing(total)
    bits = min(48, max(20, int(np.ceil(np.log2(1 + SPREAD * total / 6)))))
    given = dealt(docs, n, text)
    groups = given.groupBy("_group")
    hot = groups.applyInPandas(_sketch(bits, parts, size), MESSAGE).groupBy("to").applyInPandas(_merged_sketch, ANSWER)
    found = groups.cogroup(hot.groupBy("_group")).applyInPandas(_exact(bits, parts, size), MESSAGE)
    firsts = found.groupBy("to").applyInPandas(_merged_exact, ANSWER)
    answers = hot.unionByName(firsts)
    return groups.cogroup(answers.groupBy("_group")).applyInPandas(_finish(bits, parts, size), "doc_id long, n_words long, n_removed long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op9."""
    return dedup_windows(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
