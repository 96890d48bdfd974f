"""Periodic run detection: all maximal repetitions of a text's words, from its longest-previous-factor array.

The suffix array comes from prefix doubling; the ranks of every doubling step are kept, and tell how far any two places
agree, to the right and to the left. Neighbours in the suffix array that start earlier give each place its longest previous
factor, and jumping from factor to factor gives the Lempel-Ziv blocks. A run that touches a block's edge has a period of at
most a third of the two blocks there, and is found by extending the edge to both sides for each such period. A run
strictly inside a block is a copy of one in the block's earlier occurrence: runs are bucketed by their start, and
copied block by block.

Why a third: every place of a run after its first period has an earlier copy up to the run's end, so the first block that
starts there reaches that end; a run of four periods then leaves at most one of them before the block ahead of it.

Texts are worked on in blocks of many, one array for all; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.blobs import hashed_words
from tidings.llm.common import WORD

LEAST_LENGTH, LEAST_EXPONENT = 6, 4  # a run has max(6, 4 * period) words at least
TOGETHER = 2_000_000  # bytes of text in a block; a longer text is a block of its own
PAIRS = 1 << 20  # pairs of edges and periods tried at a time


class Ranks:
    """Ranks of the stretches of 1, 2, 4, ... tokens at each place: equal ranks for equal stretches, in their order.

    Every level but the last is a table; after the last one all ranks differ. `end[i]` is where the text of place i ends.
    A stretch that would pass the end ranks by what is left of it, before all that go on.
    """

    def __init__(self, token: np.ndarray, end: np.ndarray):
        n = len(token)
        rank = np.unique(token, return_inverse=True)[1].astype(np.int32)
        self.levels, self.end, length = [rank], end, 1
        while True:
            order = np.argsort(rank, kind="stable").astype(np.int32) if length == 1 else order
            sorted_rank = rank[order]
            first = np.flatnonzero(np.diff(sorted_rank, prepend=-1))
            size = np.diff(first, append=n)
            if (size == 1).all():
                break
            # only places that still share their rank are ordered again, by the rank of what follows
            shared = np.repeat(size > 1, size)
            at = np.flatnonzero(shared)
            who = order[at]
            group = np.repeat(first, size)[at]  # the ranks of a group are the places it takes in the order
            then = who + length
            follow = np.where(then < end[who], rank[np.minimum(then, n - 1)].astype(np.int64) + 1, 0)
            key = group.astype(np.int64) * (n + 1) + follow
            by = np.argsort(key, kind="stable")
            who, key = who[by], key[by]
            order[at] = who
            new = np.ones(len(at), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            if length == 1:  # from now on ranks are places in the order
                rank = np.empty(n, dtype=np.int32)
                rank[order] = np.repeat(first, size)
            else:
                rank = rank.copy()
            rank[who] = at[np.flatnonzero(new)][np.cumsum(new) - 1]
            length *= 2
            self.levels.append(rank)
        self.order = order

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many tokens agree from i and from j on; j > i, both in one text."""
        i, j = i.astype(np.int64), j.astype(np.int64)
        last, out = self.end[np.minimum(j, len(self.end) - 1)], np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            step, rank = 1 << k, self.levels[k]
            some = np.flatnonzero(j + step <= last)
            some = some[rank[i[some]] == rank[j[some]]]
            for x in (i, j, out):
                x[some] += step
        return out

    def left(self, i: np.ndarray, j: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many tokens agree up to i and up to j, both included; i < j, both from `begin` on, or i just before it."""
        i, j = i.astype(np.int64), j.astype(np.int64)
        out = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            step, rank = 1 << k, self.levels[k]
            some = np.flatnonzero(i - step + 1 >= begin)
            some = some[rank[i[some] - step + 1] == rank[j[some] - step + 1]]
            i[some] -= step
            j[some] -= step
            out[some] += step
        return out


def _agreeing(r: Ranks) -> np.ndarray:
    """How many tokens each suffix shares with the one before it in the order (the first with none)."""
    a, b = r.order[:-1].astype(np.int64), r.order[1:].astype(np.int64)
    out = np.zeros(len(r.order), dtype=np.int32)
    some = np.flatnonzero(r.levels[0][a] == r.levels[0][b])  # those of two texts, or of two words, share nothing
    out[some + 1] = r.right(np.minimum(a[some], b[some]), np.maximum(a[some], b[some]))
    return out


def _earlier(order: np.ndarray, agree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in the order the nearest one before it whose suffix starts earlier, and what it shares with that.

    Everybody points to the neighbour; who points to a later start takes over where that one points, until none does.
    What is skipped starts later than who skips it, so the least of the shared lengths on the way is what both share.
    """
    to, least = np.arange(-1, len(order) - 1), agree.copy()
    bad = np.flatnonzero(to >= 0)
    while True:
        bad = bad[(to[bad] >= 0) & (least[bad] > 0)]
        bad = bad[order[to[bad]] > order[bad]]
        if not len(bad):
            return to, np.where(to >= 0, least, 0)
        via = to[bad]
        to[bad], least[bad] = to[via], np.minimum(least[bad], least[via])


def longest_previous(r: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """The longest-previous-factor array: for each place the length of the longest factor there that starts earlier too, and where."""
    order, agree = r.order.astype(np.int64), _agreeing(r)
    length, source = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
    before, shared = _earlier(order, agree)
    length[order] = shared
    source[order] = order[np.maximum(before, 0)]
    back = order[::-1]
    after, shared = _earlier(back, np.append(agree[1:], 0)[::-1])
    better = shared > length[back]
    length[back[better]] = shared[better]
    source[back[better]] = back[np.maximum(after, 0)][better]
    return length, source


def blocks(length: np.ndarray) -> np.ndarray:
    """Where the Lempel-Ziv blocks start: a place's longest previous factor is a block, or a token not seen before."""
    step = np.maximum(length, 1).tolist()
    out, i, n = [], 0, len(step)
    while i < n:
        out.append(i)
        i += step[i]
    return np.array(out, dtype=np.int64)


def _at_edges(r: Ranks, token: np.ndarray, begin: np.ndarray, starts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Runs (start, end, period) that touch an edge of a block. `first`: where texts start, and at last the end of all.

    An edge of place b and a period q: the stretch where tokens q apart agree holds either b, or the place q + 1 before b.
    """
    ends = np.append(starts[1:], len(token))
    sizes = ends - starts
    opens = np.isin(starts, first)
    edge = np.concatenate([starts, first[1:]])
    most = np.concatenate([sizes + np.where(opens, 0, np.append(0, sizes[:-1])), sizes[np.searchsorted(ends, first[1:])]]) // (LEAST_EXPONENT - 1)
    lo = np.concatenate([begin[starts], begin[first[1:] - 1]])
    hi = np.concatenate([r.end[starts], first[1:]])
    found, at = [], 0
    total = np.cumsum(most)
    while at < len(edge):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        n = most[at:to]
        b, s, e = (np.repeat(x[at:to], n) for x in (edge, lo, hi))
        q = np.arange(len(b)) - np.repeat(np.cumsum(n) - n, n) + 1
        some = np.flatnonzero(b + q < e)
        some = some[token[b[some]] == token[b[some] + q[some]]]
        found.append(_extended(r, b[some], q[some], s[some]))
        some = np.flatnonzero(b - 1 - q >= s)
        some = some[token[b[some] - 1] == token[b[some] - 1 - q[some]]]
        found.append(_extended(r, b[some] - q[some] - 1, q[some], s[some]))
        at = to
    runs = np.concatenate(found or [np.zeros((0, 3), dtype=np.int64)])
    # of equal stretches the least period; a multiple of it fits just as well
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[new]


def _extended(r: Ranks, i: np.ndarray, q: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The runs of periods q around places i, where tokens q apart agree."""
    start = i + 1 - r.left(i, i + q, begin)
    end = i + q + r.right(i, i + q)
    length = end - start
    some = np.flatnonzero(length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * q))
    return np.stack([start, end, q], axis=1)[some]


def _copied(runs: np.ndarray, starts: np.ndarray, ends: np.ndarray, source: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of a text from those at edges: block by block, what lies strictly inside its earlier occurrence lies inside it."""
    bucket: dict[int, list[tuple[int, int]]] = {}
    for a, b, q in runs.tolist():
        bucket.setdefault(a, []).append((b, q))
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e - s < LEAST_LENGTH + 2:
            continue
        p = int(source[s])
        shift, last = s - p, p + e - s  # the occurrence ends before `last`
        for a in range(p + 1, last - LEAST_LENGTH):
            if a in bucket:  # a block that overlaps its occurrence finds what it has just copied
                bucket_copy = [(b + shift, q) for b, q in bucket[a] if b < last]
                if bucket_copy:
                    bucket.setdefault(a + shift, []).extend(bucket_copy)
    return sorted((a, b, q) for a, found in bucket.items() for b, q in found)


def runs_of(texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text's words, by start and period."""
    token, n = hashed_words(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(token):
        return out
    first = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(texts)), n)
    begin, end = first[:-1][owner], first[1:][owner]
    word = np.unique(token, return_inverse=True)[1]
    token = owner * np.int64(word.max() + 1) + word  # texts share no token
    r = Ranks(token, end)
    length, source = longest_previous(r)
    starts = blocks(length)
    ends = np.append(starts[1:], len(token))
    edges = np.unique(first)  # texts without a word have no edge
    found = _at_edges(r, token, begin, starts, edges)
    for d in np.unique(owner[found[:, 0]]).tolist():
        lo, hi = np.searchsorted(starts, first[d : d + 2])
        a, b = np.searchsorted(found[:, 0], first[d : d + 2])
        all_runs = _copied(found[a:b], starts[lo:hi], ends[lo:hi], source)
        out[d] = [(a - int(first[d]), b - a, q) for a, b, q in all_runs]
    return out


def _collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """A text's words without what runs repeat, joined by one space."""
    words = text.split()
    if runs:
        gone = np.zeros(len(words), dtype=bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [words[i] for i in np.flatnonzero(~gone).tolist()]
    return b" ".join(words)


def _parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > TOGETHER:
            yield start, i
            start, size = i, 0
        size += len(t)
    if len(texts) > start:
        yield start, len(texts)


def find_runs(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """doc_id, `runs` (array of start, length and period, by start and period) and `collapsed` for each row of `docs`.

    A run is a stretch of words with least period q (words q apart are equal), of max(6, 4 * q) words at least, that no
    neighbouring word extends. `collapsed` (bytes) has the words that no run holds after its first period, joined by one
    space. Null and empty texts have no run and collapse to nothing; null ids stay null; equal rows are answered alike; an
    empty table stays empty; other columns are not read. A text is read whole, by one task: one of n words takes some
    (150 + 4 * log2(its longest repeated stretch)) * n bytes there. Nothing is shuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["t"].to_list()
            for s, e in _parts(texts):
                part = [bytes(t) for t in texts[s:e]]
                runs = runs_of(part)
                told = [[{"start": a, "length": n, "period": q} for a, n, q in x] for x in runs]
                yield pd.DataFrame({"doc_id": b["i"].iloc[s:e].astype("Int64").to_numpy(dtype=object, na_value=None), "runs": told, "collapsed": [_collapsed(t, x) for t, x in zip(part, runs)]})

    raw = docs.select(F.col("doc_id").cast("long").alias("i"), F.coalesce(text, F.lit("")).cast("binary").alias("t"))
    return raw.mapInPandas(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of query op13: in one of ten documents, chosen by a hash of the id, words from some place on repeat periodically."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = docs.select("doc_id", "text", h.alias("h"), g.alias("g")).withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    n = F.size("w").cast("long")
    words = words.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))))
    source = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    text = F.concat_ws(" ", F.transform(source, lambda i: F.get("w", i.cast("int"))))
    return words.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op13."""
    found = find_runs(planted(docs.select("doc_id", "text")))
    # longest first, then least start, then least period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = found.withColumns({"best": best, "lines": F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")})
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
        F.floor(-F.col("best.l") * 1000 / F.col("best.p")).cast("long").alias("exponent_milli"), F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
