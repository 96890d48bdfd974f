"""SimHash near duplicates, with pigeonring filtering.

Fingerprints that differ in at most DIFFER bits are linked. Cut into DIFFER + 1 segments on a ring, such a pair has a
segment from which every chain of consecutive segments stays within its proportional budget: l segments differ in at most
l * DIFFER / (DIFFER + 1) bits together, so the first not at all. Equal fingerprints are one node; nodes meet in the
buckets of their segments, and there each chain's budget drops pairs before all bits are compared. Of the pairs found
only a spanning forest leaves a task.

A bucket of more than BUCKET nodes is not compared. Its nodes go to the buckets of chains of three segments instead: these
may differ in two bits after the first, so both sides give their own bits and all that differ from these in one. Where
such a bucket is still as large, its nodes are that much alike, and are linked without comparisons: each gives all
fingerprints that differ from its own in at most half of DIFFER bits, and two share one if and only if they are linked. So
work grows with the nodes, not with a bucket's pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidings.llm.common import arrow_batches, cut, join_small, partitions_of, word_pieces
from tidings.llm.graph import components
from tidings.llm.jaccard import _looked_up

SHINGLE, SEED = 4, 42
DIFFER = 4
BUCKET = 4096  # nodes of a bucket that are compared with each other
ROWS = 256  # of them at a time
BITS = (13, 13, 13, 13, 12)
SEGMENTS = [((1 << b) - 1) << sum(BITS[:i]) for i, b in enumerate(BITS)]
#: By the segment where a chain starts: masks of 1, 2, ... segments from there on, around the ring.
CHAINS = np.array([[sum(SEGMENTS[(i + k) % len(BITS)] for k in range(n)) for n in range(1, len(BITS) + 1)] for i in range(len(BITS))], dtype=np.uint64)
BUDGETS = [n * DIFFER // len(BITS) for n in range(1, len(BITS) + 1)]
ONE = np.uint64(1) << np.arange(64, dtype=np.uint64)
HALF = np.concatenate([np.zeros(1, dtype=np.uint64), ONE, (ONE[:, None] | ONE[None, :])[np.triu_indices(64, 1)]])  # all words of at most DIFFER / 2 bits


def fingerprint(text: bytes) -> int:
    """The 64 bits of a text: those set in over half of the hashes of its shingles; without a word, none."""
    ones, n, words = np.zeros(64, dtype=np.int64), 0, []
    for words, _ in word_pieces(text.lower(), SHINGLE - 1):
        if len(words) >= SHINGLE:
            hashes = [xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))]
            ones += _ones(hashes)
            n += len(hashes)
    if not n and words:
        ones, n = _ones([xxhash.xxh64_intdigest(b" ".join(words), SEED)]), 1
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _ones(hashes: list[int]) -> np.ndarray:
    """How many of the numbers have each bit."""
    return np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        prints = np.fromiter((fingerprint(bytes(t)) for t in b["t"]), dtype=np.uint64, count=len(b))
        yield pd.DataFrame({"_id": b["i"].astype("Int64").to_numpy(dtype=object, na_value=None), "_row": b["r"].to_numpy(), "node": prints.view(np.int64)})


def linked(prints: np.ndarray, start: int) -> np.ndarray:
    """(a, b) that connect those of a bucket's different fingerprints that are linked, through chains from `start`; a is b's least."""
    least = np.arange(len(prints))
    for lo in range(0, len(prints), ROWS):
        some = prints[lo : lo + ROWS]
        i, j = np.nonzero(np.arange(len(prints))[None, :] > np.arange(lo, lo + len(some))[:, None])
        i += lo
        for chain, budget in zip(CHAINS[start], BUDGETS):
            ok = np.bitwise_count((prints[i] ^ prints[j]) & chain) <= budget
            i, j = i[ok], j[ok]
        least = _joined(least, i, j)
    b = np.flatnonzero(least != np.arange(len(prints)))
    return np.stack([prints[least[b]], prints[b]], axis=1).view(np.int64)


def _joined(least: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Every place's least connected one, after these pairs too."""
    while len(i):
        a, b = least[i], least[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while (further := least[least]).tolist() != least.tolist():
            least = further
    return least


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Works on the buckets of a partition, whose rows come one bucket after another; the last of a batch waits for the next."""
    rest = None
    done = lambda rows: [linked(np.unique(g["node"].to_numpy().view(np.uint64)), start) for (_, start), g in rows.groupby(["bucket", "start"], sort=False) if len(g) > 1]
    for b in batches:
        rows = b if rest is None else pd.concat([rest, b], ignore_index=True)
        last = rows["bucket"] == rows["bucket"].iloc[-1] if len(rows) else rows["bucket"].isna()
        rest = rows[last]
        yield pd.DataFrame(np.concatenate([NONE, *done(rows[~last])]), columns=["a", "b"])
    if rest is not None:
        yield pd.DataFrame(np.concatenate([NONE, *done(rest)]), columns=["a", "b"])


NONE = np.zeros((0, 2), dtype=np.int64)


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b) that connect all nodes (`node`, different fingerprints) whose fingerprints are linked."""
    long = lambda m: F.lit(int(np.uint64(m).astype(np.int64)))
    keys = F.array(*(F.struct(F.lit(i).alias("start"), F.col("node").bitwiseAND(long(CHAINS[i, 0])).alias("key")) for i in range(len(BITS))))
    first = nodes.select("node", F.explode(keys).alias("x")).select("node", "x.start", "x.key")
    counted = first.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
    # There are no more such keys than values of the segments, 36,864 together.
    hot = cut(counted.select(F.col("start").alias("_s"), F.col("key").alias("_k")))
    same = (F.col("start") == F.col("_s")) & (F.col("key") == F.col("_k"))
    columns = ["node", "start", F.xxhash64("start", "key").alias("bucket")]
    rows, deep = first, None
    if hot.limit(1).count():
        rows = first.join(F.broadcast(hot), same, "left_anti")
        masks = F.array(*(long(CHAINS[i, 2]) for i in range(len(BITS))))
        flips = F.array(*(F.array(long(0), *(long(x) for x in ONE if x & (CHAINS[i, 2] ^ CHAINS[i, 0]))) for i in range(len(BITS))))
        own = F.col("node").bitwiseAND(F.element_at(masks, F.col("start") + 1))
        chains = first.join(F.broadcast(hot), same, "left_semi")
        chains = cut(chains.select("node", "start", F.explode(F.transform(F.element_at(flips, F.col("start") + 1), lambda x: own.bitwiseXOR(x))).alias("key")))
        large = chains.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
        large = cut(large.select(F.col("start").alias("_s"), F.col("key").alias("_k"), F.lit(True).alias("large")))
        told = join_small(chains, large, same)
        rows = rows.unionByName(told.where(F.col("large").isNull()).select("node", "start", "key"))
        deep = told.where("large").select("node").distinct()
    dealt = rows.select(*columns).repartition(partitions_of(nodes), "bucket").sortWithinPartitions("bucket", "start")
    out = dealt.mapInPandas(_compared, "a long, b long")
    if deep is not None:
        near = deep.mapInPandas(_all_near, "node long, key long")
        out = out.unionByName(near.withColumn("a", F.min("node").over(Window.partitionBy("key"))).where("a != node").select("a", F.col("node").alias("b")))
    return cut(out.distinct())


def _all_near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every fingerprint within half of DIFFER bits of each node; no more than len(HALF) nodes share one."""
    for b in batches:
        for at in range(0, len(b), 64):
            node = b["node"].to_numpy()[at : at + 64].view(np.uint64)
            yield pd.DataFrame({"node": np.repeat(node, len(HALF)).view(np.int64), "key": (node[:, None] ^ HALF[None, :]).reshape(-1).view(np.int64)})


def near_duplicates(docs: DataFrame, *, text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """For each row of `docs`: doc_id, fingerprint (16 lower-case hex digits) and component_id.

    Rows are linked when their fingerprints differ in at most DIFFER bits; `component_id` is the least id of the rows that
    links connect (null only if all of them are null). Words are taken without case (ASCII). Null texts and texts without
    a word have the fingerprint zero, and are linked like any other; a text of fewer words than a shingle is one shingle.
    Texts are read whole, however long; repeated rows are linked; an empty table stays empty; other columns are not read.
    `bucket` decides which way nodes are compared, and nothing else.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col("doc_id").cast("long").alias("i"), F.xxhash64("doc_id", text).alias("r"), F.coalesce(text, F.lit("")).cast("binary").alias("t"))
    with arrow_batches(spark, 1000):
        rows = cut(raw.mapInPandas(_fingerprints, "_id long, _row long, node long"))
    nodes = cut(rows.groupBy("node").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("copies")))
    named = components(links(nodes.select("node"), bucket)).withColumnsRenamed({"node": "_cn", "component": "_class"})
    nodes = cut(nodes.join(named, F.col("node") == F.col("_cn"), "left").select("node", "_least", "copies", F.coalesce("_class", "node").alias("class")))
    # The least id goes from nodes to components by partial minima, and back to nodes and rows.
    total = rows.count()
    first = cut(nodes.groupBy(F.col("class").alias("_k")).agg(F.min("_least").alias("component_id"), F.count(F.lit(1)).alias("in_class")))
    told = cut(_looked_up(nodes.select("node", "copies", "class"), "class", first, "_k", "in_class", F.col("node"), total).select(F.col("node").alias("_nn"), "copies", "component_id"))
    out = _looked_up(rows, "node", told, "_nn", "copies", F.xxhash64("_id", "_row", F.lit(7)), total)
    return out.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op12."""
    return near_duplicates(docs.select("doc_id", "text"))
