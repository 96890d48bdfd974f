"""Suffix-array dedup of byte strings, on a sparse suffix array merged across the cluster.

Every string of LENGTH bytes holds an anchor: the least of its GRAM-byte hashes, which equal strings share at the same
offset. Only suffixes that start at anchors are sorted, and of these only those whose GRAM bytes occur again (a sketch
counts them first). A suffix is its LENGTH bytes from the anchor, then the bytes before it, backwards, as far as a string
around the anchor can reach. Each group of documents sorts its suffixes, keeps one of each, and sends them front-coded,
as one run for each receiver; suffixes with the same GRAM bytes share a receiver. A receiver merges its runs with a loser
tree that keeps the common prefix of every loser with its winner and never compares those bytes again; the merged order
and its common prefixes tell, for each suffix and each offset, whether the string at that offset occurs earlier.

GRAM bytes that a great many anchors share would load one receiver. The counts of the sketch tell every sender which these
are; instead of their suffixes it sends the hashes of the strings themselves, each once, so that strings are dealt by all
their bytes and a receiver gets any of them at most once from each group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.blobs import dealt, join_blobs, ordered, pack, pack_bits, pack_sorted, sections, sizing, split_blobs, unpack, unpack_bits, unpack_sorted, window_hashes
from tidings.llm.common import mix64
from tidings.llm.substr import ANSWER, MESSAGE, _cuts

LENGTH = 100  # bytes of a string
GRAM = 32  # bytes hashed for anchors
OFFSETS = LENGTH - GRAM + 1  # places that an anchor can have in a string
LEFT = OFFSETS - 1  # bytes before an anchor that matter
WHOLE = LENGTH + LEFT
PAD = 0xFF  # in no UTF-8 text
SPREAD = 16  # counters for each anchor, about
CHUNK = 1 << 17
FILLED = 1 << 11  # suffixes whose rows are made or compared at a time
HOT = 20_000  # anchors with the same GRAM bytes from which their strings travel by themselves
BYTES = mix64(np.arange(1, 257, dtype=np.uint64))
BYTES_TOO = mix64(np.arange(1001, 1257, dtype=np.uint64))
MASK = (OFFSETS + 7) // 8  # bytes of a suffix's answer: a bit for each offset


class Group:
    """A group's texts, one after another in order, and its anchors."""

    def __init__(self, pdf: pd.DataFrame):
        self.ids, self.ties, self.texts, self.null = ordered(pdf)
        sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.flat = np.frombuffer(b"".join(self.texts), dtype=np.uint8)
        inside = np.zeros(len(self.flat), dtype=bool)
        for s, n in zip(self.first, sizes):
            inside[s : s + max(0, n - LENGTH + 1)] = True
        self.at, self.hash, self.start, self.n = _anchors(self.flat, inside)


def _anchors(flat: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings that start where `inside` holds: places, ascending, and hashes of their GRAM bytes.

    Besides, where the first string with each anchor starts, and how many do, one after another.
    """
    places, hashes, starts, counts = [], [], [], []
    for start in range(0, max(0, len(flat) - LENGTH + 1), CHUNK):
        want = inside[start : start + CHUNK]
        if not want.any():
            continue
        h = window_hashes(BYTES[flat[start : start + CHUNK + LENGTH - 1]], GRAM)
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        length = 1
        while length * 2 <= OFFSETS:
            least = np.minimum(least[:-length], least[length:])
            length *= 2
        if rest := OFFSETS - length:
            least = np.minimum(least[:-rest], least[rest:])
        chosen = (least[: len(want)][want[: len(least)]] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        heads = np.flatnonzero(np.diff(chosen, prepend=-1))
        starts.append(np.flatnonzero(want)[heads] + start)
        counts.append(np.diff(heads, append=len(chosen)))
        chosen = chosen[heads]
        places.append(chosen + start)
        hashes.append(h[chosen])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at, keep = np.unique(np.concatenate(places), return_index=True)  # a chunk's last anchor may be the next one's first
    return at, mix64(np.concatenate(hashes)[keep]), np.concatenate(starts)[keep], np.add.reduceat(np.concatenate(counts), keep)


def _sketch(bits: int, parts: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        g, out = Group(pdf), []
        values, n = np.unique(g.hash >> np.uint64(64 - bits), return_counts=True)
        at = _cuts(values, bits, parts)
        for k in np.flatnonzero(np.diff(at)):
            a = pack_sorted(values[at[k] : at[k + 1]])
            out.append((k, "", key[0], len(a).to_bytes(4, "little") + a + pack(n[at[k] : at[k + 1]].astype(np.uint32))))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _merged_sketch(limit: int):
    """Adds up one range of the counters; answers each sender which of its own reached two, and which reached the limit."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for data in pdf["data"]:
            n = int.from_bytes(data[:4], "little")
            parts.append((unpack_sorted(data[4 : 4 + n]), unpack(data[4 + n :])))
        uniques, inverse = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([c for _, c in parts]), minlength=len(uniques))[inverse]
        ends = np.cumsum([len(v) for v, _ in parts])[:-1]
        data = [join_blobs([pack_bits(a), pack_bits(b)]) for a, b in zip(np.split(total >= 2, ends), np.split(total >= limit, ends))]
        return pd.DataFrame({"_group": pdf["at"], "kind": "sketch", "at": key[0], "data": data})

    return run


class Suffixes:
    """The suffixes of a group at anchors that the sketch says occur again, sorted; `new` marks the first of equal ones.

    Those at hot anchors are left out; `strings` has the strings of these.
    """

    def __init__(self, g: Group, answers: dict, bits: int, parts: int):
        values, inverse = np.unique(g.hash >> np.uint64(64 - bits), return_inverse=True)
        at, flags, hot = _cuts(values, bits, parts), np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=bool)
        for k in np.flatnonzero(np.diff(at)):
            flags[at[k] : at[k + 1]], hot[at[k] : at[k + 1]] = map(unpack_bits, split_blobs(answers["sketch", k]))
        some = np.flatnonzero((flags & ~hot)[inverse])
        self.strings = Strings(g, np.flatnonzero(hot[inverse]), parts)
        place = g.at[some]
        doc = np.searchsorted(g.first, place, side="right") - 1
        self._text = _suffixes(g.flat, place, g.first[doc], g.first[doc + 1])
        self._order = order = np.argsort(self._text.view(f"S{WHOLE}").reshape(-1), kind="stable")
        self.place, self.doc = place[order], doc[order]
        self.new = np.ones(len(order), dtype=bool)
        for at in range(1, len(order), FILLED):  # the rows stay where they are; only some at a time are copied in order
            rows = self.text(np.arange(at - 1, min(at + FILLED, len(order))))
            self.new[at : at + FILLED] = (rows[1:] != rows[:-1]).any(axis=1)
        self.to = _receiver(g.hash[some][order], parts)

    def text(self, which: np.ndarray) -> np.ndarray:
        """The rows of some suffixes, by their numbers in the order."""
        return self._text[self._order[which]]


class Strings:
    """The strings whose anchors are hot, each by the hashes of its bytes (96 bits), sorted; of equal ones the first comes first."""

    def __init__(self, g: Group, hot: np.ndarray, parts: int):
        n = g.n[hot]
        start = np.repeat(g.start[hot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        hashes, checks = _string_hashes(g.flat, start)
        to = _receiver(hashes, parts)
        order = np.lexsort((start, checks, hashes, to))
        self.start, self.hash, self.check, self.to = start[order], hashes[order], checks[order], to[order]
        self.doc = np.searchsorted(g.first, self.start, side="right") - 1
        self.new = np.ones(len(order), dtype=bool)
        self.new[1:] = (self.hash[1:] != self.hash[:-1]) | (self.check[1:] != self.check[:-1])

    def sent(self, k: int) -> np.ndarray:
        """The strings that receiver k gets from this group."""
        own = np.arange(*np.searchsorted(self.to, [k, k + 1]))
        return own[self.new[own]]


def _string_hashes(flat: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes, of 64 and 32 bits, of the LENGTH bytes at each of the ascending places."""
    hashes, checks = np.empty(len(start), dtype=np.uint64), np.empty(len(start), dtype=np.uint32)
    edges = np.searchsorted(start, np.arange(0, len(flat) + CHUNK, CHUNK))
    for k in np.flatnonzero(np.diff(edges)):
        some, raw = slice(edges[k], edges[k + 1]), flat[k * CHUNK : (k + 1) * CHUNK + LENGTH - 1]
        at = start[some] - k * CHUNK
        hashes[some] = mix64(window_hashes(BYTES[raw], LENGTH)[at])
        checks[some] = mix64(window_hashes(BYTES_TOO[raw], LENGTH)[at]) >> np.uint64(32)
    return hashes, checks


def _receiver(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Receivers by the hash of the GRAM bytes, from other bits than the sketch's ranges."""
    return ((mix64(hashes) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _suffixes(flat: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A row for each anchor: LENGTH bytes from it, then LEFT bytes before it backwards; PAD outside the document."""
    out = np.empty((len(place), WHOLE), dtype=np.uint8)
    offsets = np.concatenate([np.arange(LENGTH), -1 - np.arange(LEFT)])
    for s in range(0, len(place), FILLED):  # places take eight times the memory of bytes
        some = slice(s, s + FILLED)
        at = place[some, None] + offsets
        rows = flat[np.clip(at, 0, len(flat) - 1)]
        rows[(at < begin[some, None]) | (at >= end[some, None])] = PAD
        out[some] = rows
    return out


def front_coded(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different rows as the length that each shares with the one before, and the bytes that it doesn't."""
    shared = np.zeros(len(text), dtype=np.uint8)
    if len(text) > 1:
        shared[1:] = (text[1:] != text[:-1]).argmax(axis=1)
    return shared, text[np.arange(WHOLE) >= shared[:, None]]


def decoded(shared: np.ndarray, rest: np.ndarray) -> list[bytes]:
    out, raw, at, last = [], rest.tobytes(), 0, b""
    for n in shared.tolist():
        last = last[:n] + raw[at : at + WHOLE - n]
        at += WHOLE - n
        out.append(last)
    return out


def merged(runs: list[tuple[list[int], list[bytes]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge sorted runs of equally long strings: run and index of each in order, and the length shared with the one before.

    A loser tree. `known[r]` is the length that the head of run r shares with the winner that it last lost to, or, on the
    way up, with the last output. Of two heads the one that shares more with the last output is smaller, without a look at
    any byte; only heads that share equally much are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads = [0] * k
    known = [0 if r < len(runs) and runs[r][1] else -1 for r in range(k)]
    texts = [runs[r][1] if r < len(runs) else [] for r in range(k)]
    shares = [runs[r][0] if r < len(runs) else [] for r in range(k)]
    current = [t[0] if t else b"" for t in texts]
    tree = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two heads."""
        x, y = known[a], known[b]
        if x > y:
            return a, b
        if x < y:
            return b, a
        if x < 0:
            return a, b
        s, t = current[a], current[b]
        while x < WHOLE and s[x : x + 16] == t[x : x + 16]:
            x += 16
        if x >= WHOLE:
            known[b] = WHOLE
            return a, b
        while s[x] == t[x]:
            x += 1
        if s[x] < t[x]:
            known[b] = x
            return a, b
        known[a] = x
        return b, a

    level = list(range(k))
    base = k
    while len(level) > 1:
        base //= 2
        up = []
        for i in range(0, len(level), 2):
            win, tree[base + i // 2] = play(level[i], level[i + 1])
            up.append(win)
        level = up
    win = level[0]
    out_run, out_at, out_shared = [], [], []
    for _ in range(sum(map(len, texts))):
        at = heads[win]
        out_run.append(win)
        out_at.append(at)
        out_shared.append(known[win])
        at += 1
        heads[win] = at
        if at < len(texts[win]):
            current[win], known[win] = texts[win][at], shares[win][at]
        else:
            known[win] = -1
        node = (k + win) // 2
        while node:
            other = tree[node]
            x, y = known[win], known[other]
            if x < y:
                tree[node], win = win, other
            elif x == y and x >= 0:
                win, tree[node] = play(win, other)
            node //= 2
    return np.array(out_run, dtype=np.int64), np.array(out_at, dtype=np.int64), np.array(out_shared, dtype=np.int64)


def _runs(bits: int, parts: int):
    def run(key, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(docs):
            g = Group(docs)
            s = Suffixes(g, sections(answers), bits, parts)
            firsts = np.flatnonzero(s.new)
            for k in np.union1d(s.to[firsts], s.strings.to):
                own = firsts[s.to[firsts] == k]
                shared, rest = front_coded(s.text(own))
                used, local = np.unique(s.doc[own], return_inverse=True)
                place = (s.place[own] - g.first[s.doc[own]]).astype(np.uint32)
                blobs = [pack(shared), pack(rest), pack(local.astype(np.uint32)), pack(place), pack(g.ids[used]), pack(g.ties[used])]
                own = s.strings.sent(k)
                used, local = np.unique(s.strings.doc[own], return_inverse=True)
                place = (s.strings.start[own] - g.first[s.strings.doc[own]]).astype(np.uint32)
                blobs += [pack_sorted(s.strings.hash[own]), pack(s.strings.check[own]), pack(local.astype(np.uint32)), pack(place), pack(g.ids[used]), pack(g.ties[used])]
                out.append((k, "", key[0], join_blobs(blobs)))
        return pd.DataFrame(out, columns=["to", "kind", "at", "data"])

    return run


def _merged_runs(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Answers, for each suffix, at which offsets its string occurs earlier, and, for each string of hot anchors, whether it does."""
    blobs = [split_blobs(data) for data in pdf["data"]]
    data = [join_blobs(x) for x in zip(_merged_suffixes([b[:6] for b in blobs]), _merged_strings([b[6:] for b in blobs]))]
    return pd.DataFrame({"_group": pdf["at"], "kind": "suffix", "at": key[0], "data": data})


def _merged_strings(senders: list[list[bytes]]) -> list[bytes]:
    """For each string of each sender, whether another sender has it earlier."""
    cols = [[], [], [], [], []]
    for hashes, *rest in senders:
        check, local, place, ids, ties = map(unpack, rest)
        for c, x in zip(cols, (place, ties[local], ids[local], check, unpack_sorted(hashes))):
            c.append(x)
    ends = np.cumsum([len(x) for x in cols[0]])[:-1]
    cols = [np.concatenate(c) for c in cols]
    order = np.lexsort(cols)
    check, hashes = cols[3][order], cols[4][order]
    again = np.zeros(len(order), dtype=bool)
    again[order[1:]] = (hashes[1:] == hashes[:-1]) & (check[1:] == check[:-1])
    return [pack_bits(x) for x in np.split(again, ends)]


def _merged_suffixes(senders: list[list[bytes]]) -> list[bytes]:
    """Merges the runs of all senders; for each suffix, a mask of the offsets at which its string occurs earlier."""
    runs, cols = [], [[], [], []]
    for data in senders:
        shared, rest, local, place, ids, ties = map(unpack, data)
        runs.append((shared.tolist(), decoded(shared, rest)))
        for c, x in zip(cols, (ids[local], ties[local], place)):
            c.append(x)
    sizes = [len(r[0]) for r in runs]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    ids, ties, place = (np.concatenate(c) for c in cols)
    if not len(ids):
        return [pack(np.zeros(0, dtype=np.uint8))] * len(runs)
    rank = np.empty(len(ids), dtype=np.int64)
    rank[np.lexsort((place, ties, ids))] = np.arange(len(ids))
    run, at, shared = merged(runs)
    entry = begin[run] + at
    starts = np.flatnonzero(shared < WHOLE)
    kind = np.cumsum(shared < WHOLE) - 1  # of each output: which different suffix it is
    first = np.minimum.reduceat(rank[entry], starts)
    text = np.frombuffer(b"".join(runs[run[i]][1][at[i]] for i in starts), dtype=np.uint8).reshape(-1, WHOLE)
    earlier = np.packbits(_earlier(text, np.minimum(shared[starts], LENGTH), first), axis=1)
    masks = np.full((len(ids), MASK), 0xFF, dtype=np.uint8)
    lead = rank[entry] == first[kind]
    masks[entry[lead]] = earlier[kind[lead]]
    return [pack(m.reshape(-1)) for m in np.split(masks, begin[1:-1])]


def _earlier(text: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each of the sorted different suffixes and each offset: does its string there start earlier in another one?

    `right`: bytes shared from the anchor on with the suffix before. At offset o a string is the o bytes before the anchor
    and LENGTH - o from it. Suffixes that share the latter are neighbours in this order, those that share the former are
    neighbours in the order of their left sides; so the pair of both neighbourhoods names the string.
    """
    out = np.zeros((len(text), OFFSETS), dtype=bool)
    family = np.cumsum(right < GRAM)
    lefts = np.ascontiguousarray(np.concatenate([family.astype(">u8").view(np.uint8).reshape(-1, 8), text[:, LENGTH:]], axis=1))
    by_left = np.argsort(lefts.view(f"S{8 + LEFT}").reshape(-1), kind="stable")
    ordered_lefts = lefts[by_left]
    differ = ordered_lefts[1:] != ordered_lefts[:-1]
    left = np.full(len(text), -1, dtype=np.int64)  # bytes shared to the left with the neighbour before; -1 over a family's edge
    left[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), 8 + LEFT) - 8
    next_to = lambda x: np.maximum(x, np.append(x[1:], -1))
    most_left = np.empty_like(left)
    most_left[by_left] = next_to(left)
    some = np.flatnonzero(next_to(np.where(right < GRAM, -1, right)) + most_left >= LENGTH)
    if not len(some):
        return out
    has_right, has_left = (text[some, :LENGTH] != PAD).sum(axis=1), (text[some, LENGTH:] != PAD).sum(axis=1)
    hood = np.empty(len(text), dtype=np.int64)
    for o in range(OFFSETS):
        hood[by_left] = np.cumsum(left < o)
        ok = (has_left >= o) & (has_right >= LENGTH - o)
        who = some[ok]
        if len(who) < 2:
            continue
        pair = np.cumsum(right < LENGTH - o)[who] * np.int64(len(text) + 1) + hood[who]
        order = np.lexsort((rank[who], pair))
        again = np.zeros(len(who), dtype=bool)
        again[order[1:]] = pair[order][1:] == pair[order][:-1]
        out[who[again], o] = True
    return out


def _removed(g: Group, s: Suffixes, answers: dict) -> np.ndarray:
    """Which bytes of the group go."""
    firsts = np.flatnonzero(s.new)
    masks, again = np.full((len(s.place), OFFSETS), True), ~s.strings.new
    for k in np.union1d(s.to[firsts], s.strings.to):
        own = firsts[s.to[firsts] == k]
        mask, earlier = split_blobs(answers["suffix", k])
        masks[own] = np.unpackbits(unpack(mask).reshape(-1, MASK), axis=1)[:, :OFFSETS]
        again[s.strings.sent(k)] = unpack_bits(earlier)
    begin, end = g.first[s.doc], g.first[s.doc + 1]
    full = masks.all(axis=1)
    lo, hi = np.maximum(s.place - LEFT, begin)[full], np.minimum(s.place, end - LENGTH)[full]
    i, o = np.nonzero(masks & ~full[:, None])
    n = len(g.flat) + LENGTH + 1
    up = np.concatenate([lo[hi >= lo], s.place[i] - o, s.strings.start[again]])
    down = np.concatenate([hi[hi >= lo], s.place[i] - o, s.strings.start[again]]) + LENGTH
    return np.cumsum(np.bincount(up, minlength=n) - np.bincount(down, minlength=n))[: len(g.flat)] > 0


def _finish(bits: int, parts: int):
    def run(key, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(docs):
            g, known = Group(docs), sections(answers)
            gone = _removed(g, Suffixes(g, known, bits, parts), known)
            for i, t in enumerate(g.texts):
                cut = gone[g.first[i] : g.first[i + 1]]
                n = int(cut.sum())
                kept = g.flat[g.first[i] : g.first[i + 1]][~cut].tobytes() if n else t
                out.append((None if g.null[i] else int(g.ids[i]), len(t), n, int((np.diff(cut.astype(np.int8), prepend=0) == 1).sum()), kept))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})

    return run


def dedup_bytes(docs: DataFrame, *, text: str = "text", hot_from: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and `kept` (the bytes left) for each row of `docs`.

    A byte goes if a LENGTH-byte string around it starts earlier elsewhere too: in a document of smaller id, or earlier in
    the same. Null ids come last; rows of equal id are ordered by a hash of their text, and of fully equal rows one, no
    matter which, counts as the first. Null texts count as empty; shorter texts keep all bytes; an empty table stays empty;
    texts are read whole, and a very long one makes its group, which one task holds, so much larger; other columns are not read.
    `hot_from` decides by which way strings are compared, and nothing else.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n, parts = sizing(size)
    bits = min(48, max(20, int(np.ceil(np.log2(1 + SPREAD * size / (OFFSETS / 2))))))
    groups = dealt(docs, n, text).groupBy("_group")
    hot = groups.applyInPandas(_sketch(bits, parts), MESSAGE).groupBy("to").applyInPandas(_merged_sketch(hot_from), ANSWER)
    runs = groups.cogroup(hot.groupBy("_group")).applyInPandas(_runs(bits, parts), MESSAGE)
    answers = hot.unionByName(runs.groupBy("to").applyInPandas(_merged_runs, ANSWER))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return groups.cogroup(answers.groupBy("_group")).applyInPandas(_finish(bits, parts), schema)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op10."""
    return dedup_bytes(docs.select("doc_id", "text")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
