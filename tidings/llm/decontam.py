"""Benchmark decontamination: rare word n-grams seed, Smith-Waterman alignment decides.

A test item's word trigrams are looked up in every text; the stretch around those that fall close together is aligned to the
item, so edited and paraphrased copies score as well as exact ones. Trigrams that are rare in the corpus, measured over
all documents, are seeds that lead to an alignment at once. A stretch that only frequent ones mark is aligned unless too
few of the item's words occur in it for a reported score; so how often a trigram occurs decides on work alone, and never
on the verdict. The items are taken in blocks of bounded size; LIVE blocks are broadcast together, counted in one scan and
searched in another. A larger benchmark takes several rounds, of which each frees its broadcasts and leaves only what it found.
"""

from collections.abc import Iterator
from functools import reduce
from itertools import islice, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import cut, free_name

N = 3  # words of a seed
BLOCK_WORDS = 1_000_000  # of benchmark text in one broadcast index
LIVE = 4  # blocks that are broadcast at the same time
RARE = 50  # documents; seeds up to this, or up to the median of their item, are rare
POSTINGS = 2_000_000  # of trigrams met in texts that are clustered together
MATCH, MISMATCH, GAP = 1.0, -0.6, -0.6
REPORT_AT = 0.5  # alignment score over the item's number of words
BATCH = 256  # alignments computed together
PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)

LEAKS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("start_word", T.IntegerType()), T.StructField("end_word", T.IntegerType()),
]))


def words_of(text: str | None) -> list[bytes]:
    """Words without case (ASCII) and punctuation."""
    return (text or "").encode().lower().translate(PUNCTUATION).split()


class Index:
    """A block of items: their words as numbers, and their trigrams with the places where items have them."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.items = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(t)], dtype=np.int64) for _, t in items]
        self.base = np.int64(len(self.vocabulary) + 1)
        grams = [self.grams(x) for x in self.items]
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        offset = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, dtype=np.int64)])
        flat = np.concatenate(grams or [np.zeros(0, dtype=np.int64)])
        order = np.argsort(flat, kind="stable")
        self.keys, self.first = np.unique(flat[order], return_index=True)
        self.end = np.append(self.first[1:], len(flat))
        self.owner, self.offset = owner[order], offset[order]
        self.by_gram = np.repeat(np.arange(len(self.keys)), self.end - self.first) * len(items) + self.owner  # ascending
        self.rare = np.ones(len(flat), dtype=bool)

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """Trigram keys by position; -1 where a word is in no item. Blocks are small enough for keys to be exact."""
        if len(ids) < N:
            return np.zeros(0, dtype=np.int64)
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        return np.where((a > 0) & (b > 0) & (c > 0), (a * self.base + b) * self.base + c, -1)

    def mark_rare(self, df: np.ndarray) -> None:
        """Mark postings of trigrams that are not frequent, either in itself or among those of their item."""
        counts = np.repeat(df, self.end - self.first)
        limit = np.full(len(self.items), float(RARE))
        order = np.argsort(self.owner, kind="stable")
        for i, part in zip(*_groups(self.owner[order], counts[order])):
            limit[i] = max(RARE, float(np.median(part)))
        self.rare = counts <= limit[self.owner]

    def numbers(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The texts' words as numbers, one after another with gaps of N zeros, and where each text begins."""
        parts, starts, at = [], [], 0
        get = self.vocabulary.get
        for t in texts:
            w = words_of(t)
            x = np.zeros(len(w) + N, dtype=np.int64)
            x[: len(w)] = np.fromiter(map(get, w, repeat(0)), dtype=np.int64, count=len(w))
            parts.append(x)
            starts.append(at)
            at += len(x)
        return np.concatenate(parts or [np.zeros(0, dtype=np.int64)]), np.array([*starts, at], dtype=np.int64)

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that hold a trigram of the index, and which."""
        grams = self.grams(numbers)
        at = np.flatnonzero(grams >= 0)
        if not len(at) or not len(self.keys):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        key = grams[at]
        where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = self.keys[where] == key
        return at[ok], where[ok]

    def leaks(self, texts) -> list[list[dict]]:
        """For each text the items found in it, each with its best alignment."""
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        numbers, starts = self.numbers(texts)
        at, gram = self.hits(numbers)
        best: dict[tuple[int, int], tuple] = {}
        for some, first, end in self.slices(np.searchsorted(starts, at, side="right") - 1, gram):
            for some_tasks in _batches(self.tasks(numbers, starts, at[some], first, end)):
                self.judge(some_tasks, numbers, starts, best)
        for (d, i), (s, b, e) in sorted(best.items()):
            out[d].append({"item_id": self.ids[i], "score": round(s, 6), "start_word": b, "end_word": e})
        return out

    def slices(self, doc: np.ndarray, gram: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Hits by whole documents, with the range of postings of each, so that about POSTINGS come together.

        A document with more is taken several times, each time with the postings of some of the items.
        """
        total = np.concatenate([[0], np.cumsum(self.end[gram] - self.first[gram])])
        edges = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
        k = 0
        while k + 1 < len(edges):
            lo = edges[k]
            k = max(k + 1, int(np.searchsorted(total[edges], total[lo] + POSTINGS, side="right")) - 1)
            some, n = slice(lo, edges[k]), int(total[edges[k]] - total[lo])
            base, turns = gram[some] * len(self.items), min(len(self.items), -(-n // POSTINGS))
            for t in range(turns):
                a, b = t * len(self.items) // turns, (t + 1) * len(self.items) // turns
                yield some, np.searchsorted(self.by_gram, base + a), np.searchsorted(self.by_gram, base + b)

    def tasks(self, numbers: np.ndarray, starts: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple]:
        """Stretches to align, by width: width, text, item, place."""
        n = end - begin
        if not n.sum():
            return []
        post = np.repeat(begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        pos, item, offset, rare = np.repeat(at, n), self.owner[post], self.offset[post], self.rare[post]
        doc = np.searchsorted(starts, pos, side="right") - 1
        order = np.lexsort((pos, item, doc))
        pos, item, offset, doc, rare = pos[order], item[order], offset[order], doc[order], rare[order]
        length = np.array([len(x) for x in self.items])[item]
        new = np.ones(len(pos), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (pos[1:] - pos[:-1] > length[1:])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(pos))
        lo = np.minimum.reduceat(pos - offset, first)
        hi = np.maximum.reduceat(pos - offset, first) + length[first]
        pad = length[first] // 4 + 2
        lo, hi = np.maximum(lo - pad, starts[doc[first]]), np.minimum(hi + pad, starts[doc[first] + 1] - N)
        cluster = np.repeat(np.arange(len(first)), last - first)
        sure = np.bincount(cluster[rare], minlength=len(first)) > 0
        return sorted(
            (int(hi[k] - lo[k]), int(doc[first[k]]), int(item[first[k]]), int(lo[k]))
            for k in np.flatnonzero(hi > lo) if sure[k] or self.possible(item[first[k]], numbers[lo[k] : hi[k]])
        )

    def possible(self, item: int, window: np.ndarray) -> bool:
        """False only where no alignment can be reported: a score is at most the number of the item's words in the window."""
        x = self.items[item]
        return np.isin(x, window).sum() / len(x) >= REPORT_AT

    def judge(self, some: list[tuple], numbers: np.ndarray, starts: np.ndarray, best: dict[tuple[int, int], tuple]) -> None:
        """Align some stretches; `best` keeps each text's and item's best reported score and its place."""
        items = [self.items[i] for _, _, i, _ in some]
        windows = [numbers[p : p + n] for n, _, _, p in some]
        score, end_i, end_w = align(items, windows)
        for k, (_, d, i, p) in enumerate(some):
            s = float(score[k]) / len(items[k])
            if s >= REPORT_AT and s > best.get((d, i), (0.0,))[0]:
                _, _, back = align([items[k][: end_i[k]][::-1]], [windows[k][: end_w[k]][::-1]])
                end = int(p - starts[d] + end_w[k])
                best[d, i] = (s, end - int(back[0]), end)


def _groups(key: np.ndarray, value: np.ndarray):
    ids, first = np.unique(key, return_index=True)
    return ids, np.split(value, first[1:])


def _batches(tasks: list[tuple]) -> Iterator[list[tuple]]:
    """Alignments of like width together; fewer of them where they are wide."""
    some: list[tuple] = []
    for t in tasks:
        if some and (len(some) >= BATCH or t[0] * (len(some) + 1) > 4_000_000 or t[0] > 2 * some[0][0] + 64):
            yield some
            some = []
        some.append(t)
    if some:
        yield some


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Local alignment of each item to its window: best score, and the ends of the best alignment in both.

    A row of all tables is computed at once; gaps along the row come from a running maximum.
    """
    rows, cols = max(map(len, items)), max(map(len, windows))
    a = np.full((len(items), rows), -1, dtype=np.int64)
    b = np.full((len(items), cols), -2, dtype=np.int64)
    for k, (x, y) in enumerate(zip(items, windows)):
        a[k, : len(x)], b[k, : len(y)] = x, y
    ramp = -GAP * np.arange(cols + 1)
    h = np.zeros((len(items), cols + 1))
    best, end_i, end_w = np.zeros(len(items)), np.zeros(len(items), dtype=np.int64), np.zeros(len(items), dtype=np.int64)
    every = np.arange(len(items))
    for i in range(rows):
        new = np.zeros_like(h)
        np.maximum(h[:, :-1] + np.where(b == a[:, i, None], MATCH, MISMATCH), h[:, 1:] + GAP, out=new[:, 1:])
        np.maximum(new, 0, out=new)
        h = np.maximum.accumulate(new + ramp, axis=1) - ramp
        top = h.argmax(1)
        value = h[every, top]
        better = value > best + 1e-9
        best[better], end_i[better], end_w[better] = value[better], i + 1, top[better]
    return best, end_i, end_w


def _frequencies(docs: DataFrame, held: list, text: str) -> list[np.ndarray]:
    """For each block, the documents that hold each of its trigrams, counted over all of them in one scan; each task sends one row for each it met."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: list = [None] * len(held)
        for batch in batches:
            for k, h in enumerate(held):
                index = h.value
                numbers, starts = index.numbers(batch["t"])
                at, gram = index.hits(numbers)
                n = max(1, len(index.keys))
                found = np.bincount(np.unique((np.searchsorted(starts, at, side="right") - 1) * n + gram) % n, minlength=len(index.keys))
                totals[k] = found if totals[k] is None else totals[k] + found
        for k, total in enumerate(totals):
            if total is not None:
                some = np.flatnonzero(total)
                yield pd.DataFrame({"block": k, "gram": some, "df": total[some]})

    out = [np.zeros(len(h.value.keys), dtype=np.int64) for h in held]
    rows = docs.select(F.col(text).alias("t")).mapInPandas(count, "block int, gram long, df long").groupBy("block", "gram").agg(F.sum("df").alias("df"))
    for r in rows.toLocalIterator():  # at most one row for each trigram of the blocks
        out[r["block"]][r["gram"]] = r["df"]
    return out


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The items, each once, in blocks of at most BLOCK_WORDS words or one item. The driver holds one block at a time."""
    some, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), "text").distinct().toLocalIterator():
        n = len(words_of(r["text"]))
        if some and size + n > BLOCK_WORDS:
            yield Index(some)
            some, size = [], 0
        some.append((r["item_id"], r["text"]))
        size += n
    if some:
        yield Index(some)


def _search(held):
    """The function that looks up one broadcast block."""

    @F.pandas_udf(LEAKS)
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.leaks(list(texts)), dtype=object)

    return search


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `leaks`: item_id, score (alignment score for each word of the item, 1 for an exact copy) and the passage's words.

    A column of that name is replaced, all others, whatever their names, are kept. Null, empty and short texts and items of
    fewer than three words match nothing; texts are read whole; an empty benchmark gives empty arrays and an empty table
    stays empty; repeated rows get equal results; items with equal id and text count once; every item that a document
    holds is reported with its best passage, by item.
    """
    sc, blocks = docs.sparkSession.sparkContext, _blocks(benchmark)
    order = lambda x: F.array_sort(F.filter(x, lambda y: y.isNotNull()))
    rounds: list[DataFrame] = []
    key = F.struct(F.col("doc_id"), F.xxhash64(text), F.xxhash64(F.lit(1), text)) if "doc_id" in docs.columns else F.struct(F.xxhash64(text), F.xxhash64(F.lit(1), text))
    some = list(islice(blocks, LIVE))
    while some:
        held = [sc.broadcast(x) for x in some]
        for index, df in zip(some, _frequencies(docs, held, text)):
            index.mark_rare(df)
        for h in held:
            h.destroy()
        held = [sc.broadcast(x) for x in some]
        found = order(F.concat(*(_search(h)(F.col(text)) for h in held)))
        some = list(islice(blocks, LIVE))
        if not some and not rounds:
            return docs.withColumn("leaks", found)
        part = docs.select(key.alias("k"), found.alias("x")).where(F.size("x") > 0).groupBy("k").agg(F.first("x").alias("x"))
        rounds.append(cut(part))
        for h in held:
            h.destroy()
    if not rounds:
        return docs.withColumn("leaks", F.array().cast(LEAKS))
    told = reduce(DataFrame.unionByName, rounds).groupBy("k").agg(F.flatten(F.collect_list("x")).alias("x"))
    a, b = free_name("_key", docs), free_name("_found", docs)
    joined = docs.withColumn(a, key).join(told.withColumnsRenamed({"k": b, "x": f"{b}_x"}), F.col(a).eqNullSafe(F.col(b)), "left")
    return joined.withColumn("leaks", F.coalesce(order(F.col(f"{b}_x")), F.array().cast(LEAKS))).drop(a, b, f"{b}_x")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item found in it."""
    leaks = find_leaks(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("leaks").alias("x"))
    return leaks.select("doc_id", "x.item_id", "x.score", "x.start_word", "x.end_word")
