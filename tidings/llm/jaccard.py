"""N-gram Jaccard join with Bayesian candidate pruning.

A text is the set of its five-word shingles. Texts with equal sets are one node. Nodes that share a band of MinHash values
are candidates: they meet in that band's bucket with their signatures alone, and MinHash values are compared a few at a
time; a pair is dropped as soon as the posterior probability (uniform prior, binomial evidence) that its similarity reaches
the threshold falls below the tolerance. What survives connects nodes to families; only their members' shingles are
fetched, and within a family all pairs of like size that survive are verified exactly, in blocks. Only links a node has,
counted, and spanning forests leave a task.

A bucket with very many nodes is parted by size, then cut into blocks that share one leading node. Blocks of nodes that are then not yet of the
bucket's largest family are compared with all blocks, so no pair is lost and none within one family is compared again.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidings.llm.blobs import hashed_words, window_hashes
from tidings.llm.common import HOT_KEYS, arrow_batches, cut, free_name, mix64, partitions_of
from tidings.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND = 32, 4  # a pair of similarity 0.8 shares no band with probability 5e-8
HASHES = BANDS * BAND
STEP = 16  # values compared at a time
TOLERANCE = 1e-7
BUCKET = 4096  # nodes of a bucket that are compared in one task
BLOCK, BLOCK_BYTES = 128, 32e6  # a family of n nodes is cut into the root of n / BLOCK blocks, or by bytes of its sets if these are more
MIX_A = (mix64(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
MIX_B = (mix64(np.arange(1001, HASHES + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sets of the texts' shingles as ascending hashes. A shorter text with a word is one shingle; without, none."""
    flat, counts = hashed_words(texts)
    hashes, out, at = window_hashes(flat, SHINGLE), [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            out.append(np.unique(hashes[at : at + n - SHINGLE + 1]))
        else:
            out.append(mix64(window_hashes(flat[at : at + n], n) + np.uint64(n)) if n else np.zeros(0, dtype=np.uint64))
        at += n
    return out


def node_name(s: np.ndarray) -> int:
    """64 bits that stand for a set."""
    with np.errstate(over="ignore"):
        return int(mix64(np.array([mix64(s).sum(dtype=np.uint64) ^ np.uint64(len(s))], dtype=np.uint64)).view(np.int64)[0])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of MinHash values (16 bits of each) for each set; none of the sets is empty."""
    flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    high = (mix64(flat) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((HASHES, len(sets)), dtype=np.uint16)
    for k in range(HASHES):  # odd factors permute the 32-bit numbers
        out[k] = np.minimum.reduceat(high * MIX_A[k] + MIX_B[k], starts) & np.uint32(0xFFFF)
    return np.ascontiguousarray(out.T)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For 16, 32, ... compared values, the fewest matches with which the threshold may still be reached.

    With m of n matches and a uniform prior the similarity is Beta(m + 1, n - m + 1); that it is at least t has the
    probability of at most m successes in n + 1 trials of chance t.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def survivors(row: np.ndarray, others: np.ndarray, least: list[int]) -> np.ndarray:
    """Which of the other signatures the evidence doesn't rule out for this one."""
    at, n = np.arange(len(others)), 0
    for step, enough in enumerate(least):
        s = slice(step * STEP, (step + 1) * STEP)
        n = n + (others[at, s] == row[s]).sum(axis=1)
        keep = n >= enough
        at, n = at[keep], n[keep]
        if not len(at):
            break
    return at


class Families:
    """Nodes by family: `label`, and the pairs that joined two of them."""

    def __init__(self, label: np.ndarray):
        self.label, self.edges = label, []

    def join(self, i: int, others: np.ndarray) -> None:
        for other in np.unique(self.label[others]).tolist():
            if other != self.label[i]:
                self.edges.append((i, int(others[np.argmax(self.label[others] == other)])))
                self.label[self.label == other] = self.label[i]


class Overlap:
    """Sizes of the intersections of sets with each other.

    Shingles that more than half of the sets have are counted where they are missing instead: near copies differ in few,
    and |A and B| = F - missing(A) - missing(B) + (shingles told of both), F being how many are counted this way.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        keys, column = np.unique(flat, return_inverse=True)
        count = np.bincount(column)
        often = count * 2 > len(sets)
        self.often = int(often.sum())
        usual = (count[column] > 1) & ~often[column]
        has = np.zeros((len(sets), self.often), dtype=bool)
        place = np.cumsum(often) - 1
        has[owner[often[column]], place[column[often[column]]]] = True
        miss_owner, miss = np.nonzero(~has)
        self.missing = np.bincount(miss_owner, minlength=len(sets))
        owner, column = np.concatenate([owner[usual], miss_owner]), np.concatenate([column[usual], len(keys) + miss])
        order = np.lexsort((owner, column))
        self.by_column, columns = owner[order], column[order]
        self.ends = np.searchsorted(columns, np.arange(len(keys) + self.often + 1))
        order = np.lexsort((column, owner))
        self.of_row, self.row_ends = column[order], np.searchsorted(owner[order], np.arange(len(sets) + 1))

    def common(self, row: int) -> np.ndarray:
        """How many shingles a set shares with each other set."""
        told = self.of_row[self.row_ends[row] : self.row_ends[row + 1]]
        begin, length = self.ends[told], self.ends[told + 1] - self.ends[told]
        at = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())
        both = np.bincount(self.by_column[at], minlength=self.n)
        return self.often - self.missing[row] - self.missing + both


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row's node, size and signature; null for rows without a word."""
    for b in batches:
        for at in range(0, len(b), 128):
            part = b.iloc[at : at + 128]
            sets = shingle_sets([bytes(t) for t in part["t"]])
            some = [i for i, s in enumerate(sets) if len(s)]
            rows = signatures([sets[i] for i in some]) if some else []
            node, sign = [None] * len(sets), [None] * len(sets)
            for i, r in zip(some, rows):
                node[i], sign[i] = node_name(sets[i]), r.tobytes()
            yield pd.DataFrame({"_id": part["i"].astype("Int64").to_numpy(), "_row": part["r"].to_numpy(), "node": pd.array(node, dtype="Int64"), "size": [len(s) for s in sets], "sign": sign})


def _by_task(batches: Iterator[pd.DataFrame], columns: list[str], work) -> Iterator[pd.DataFrame]:
    """Works on the tasks of a partition, whose members come one task after another; a batch's last task waits for the next batch."""
    rest: list[tuple] = []

    def done(rows: list[tuple]) -> Iterator[pd.DataFrame]:
        found = [x for s, e in _stretches([r[0] for r in rows]) if len(x := work(rows[s:e]))]
        if found:
            yield pd.DataFrame(np.concatenate(found), columns=["a", "b", "n"])

    for b in batches:
        rest += list(zip(*(b[c].tolist() if b[c].dtype != object else b[c] for c in columns)))
        last = len(rest)
        while last and rest[last - 1][0] == rest[-1][0]:
            last -= 1
        yield from done(rest[:last])
        rest = rest[last:]
    yield from done(rest)


NOTHING = np.zeros((0, 3), dtype=np.int64)


def _signs(rows: list[tuple], at: int) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r[at]) for r in rows), dtype=np.uint16).reshape(-1, HASHES)


def _connect(rows: list[tuple], least: list[int]) -> np.ndarray:
    """A block of a bucket with itself, or with another: (a, b, number of pairs compared) for pairs that join two families."""
    rows = sorted(rows, key=lambda r: (r[1], r[2]))
    first = sum(r[1] == 0 for r in rows)
    same = first == len(rows)
    if first == 0 or len(rows) < 2:
        return NOTHING
    node, sign = np.array([r[2] for r in rows], dtype=np.int64), _signs(rows, 4)
    _, label = np.unique(np.array([r[3] for r in rows], dtype=np.int64), return_inverse=True)
    families, compared = Families(label), 0
    for i in range(first):
        others = np.flatnonzero(families.label[i + 1 :] != families.label[i]) + i + 1 if same else np.flatnonzero(families.label[first:] != families.label[i]) + first
        if len(others):
            compared += len(others)
            families.join(i, others[survivors(sign[i], sign[others], least)])
    return np.array([(node[i], node[j], compared * (k == 0)) for k, (i, j) in enumerate(families.edges)] or NOTHING, dtype=np.int64)


def _stretches(keys: list) -> Iterator[tuple[int, int]]:
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield start, i
            start = i


def _verify(rows: list[tuple], least: list[int], threshold: float = THRESHOLD) -> np.ndarray:
    """A block of a family with itself or another, exactly. Rows of (a, b, n): n > 0 links of node a, by copies; n = 0 a pair of a spanning forest."""
    rows = sorted(rows, key=lambda r: (r[1], r[2]))
    first = sum(r[1] == 0 for r in rows)
    same = first == len(rows)
    if first == 0 or len(rows) < 2:
        return NOTHING
    node, copies = np.array([r[2] for r in rows], dtype=np.int64), np.array([r[3] for r in rows], dtype=np.int64)
    sign, sets = _signs(rows, 4), [np.frombuffer(bytes(r[5]), dtype=np.uint64) for r in rows]
    size, families, n, overlap = np.array([len(s) for s in sets]), Families(np.arange(len(rows))), np.zeros(len(rows), dtype=np.int64), None
    for i in range(first):
        begin = i + 1 if same else first
        others = survivors(sign[i], sign[begin:], least) + begin
        if not len(others):
            continue
        if len(others) < 8 and overlap is None:
            common = np.array([_common(sets[i], sets[j]) for j in others])
        else:
            overlap = overlap or Overlap(sets)
            common = overlap.common(i)[others]
        others = others[common >= threshold * (size[i] + size[others] - common) - 1e-9]
        n[i] += copies[others].sum()
        n[others] += copies[i]
        families.join(i, others)
    linked = np.flatnonzero(n)
    links = np.stack([node[linked], np.zeros(len(linked), dtype=np.int64), n[linked]], axis=1)
    edges = np.array([(node[i], node[j], 0) for i, j in families.edges] or NOTHING, dtype=np.int64)
    return np.concatenate([links, edges])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _sets_of(docs: DataFrame, members: DataFrame, text: str) -> DataFrame:
    """(node, set) of the members, each once; nothing passes through the driver."""
    raw = docs.select(F.coalesce(text, F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent: set[int] = set()
        for b in batches:
            for at in range(0, len(b), 128):
                out = []
                for s in shingle_sets([bytes(t) for t in b["t"].iloc[at : at + 128]]):
                    if len(s):
                        node = node_name(s)
                        if node not in sent:
                            sent.add(node)
                            out.append((node, s.tobytes()))
                yield pd.DataFrame(out, columns=["_sn", "set"])

    sets = raw.mapInPandas(run, "_sn long, set binary")
    sets = sets.join(members.select(F.col("node").alias("_m")), F.col("_sn") == F.col("_m"), "left_semi")
    return sets.groupBy("_sn").agg(F.first("set").alias("set"))


def _tasks(rows: DataFrame, parts: int, columns: list[str], work) -> DataFrame:
    """(a, b, n) from all tasks of `rows`."""
    least = least_matches()
    dealt = rows.select(*columns).repartition(parts, "task").sortWithinPartitions("task")
    return cut(dealt.mapInPandas(lambda it: _by_task(it, columns, lambda x: work(x, least)), "a long, b long, n long"))


def size_class(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / F.lit(float(np.log(1 / THRESHOLD)))).cast("int")


def _met(bands: DataFrame) -> DataFrame:
    """The rows (node, size, band) of buckets that two nodes or more share, with the bucket's number of blocks and its leading node."""
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lead")).where("n > 1")
    shared = cut(shared.select(F.col("band").alias("_b"), F.ceil(F.col("n") / BUCKET).cast("int").alias("blocks"), "lead"))
    return bands.join(shared, F.col("band") == F.col("_b")).select("node", "size", "band", "blocks", "lead")


def candidates(nodes: DataFrame, parts: int) -> DataFrame:
    """(a, b, n) that connect all nodes (node, size, sign) that share a band and survive; the sum of `n` is how many pairs were compared."""
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring("sign", k * BAND * 2 + 1, BAND * 2)))
    met = cut(_met(nodes.select("node", "size", F.explode(band).alias("band"))))
    large = met.where("blocks > 1")
    if large.limit(1).count():
        # Sets of similarity THRESHOLD are of the same or the next size class, so a large bucket is one for each two neighbouring ones.
        own = size_class(F.col("size"))
        halves = large.select("node", "size", F.explode(F.array(F.xxhash64("band", own), F.xxhash64("band", own + 1))).alias("band"))
        met = cut(met.where("blocks = 1").unionByName(_met(halves)))
    signs = nodes.select(F.col("node").alias("_n"), "sign")
    block = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int")
    own = F.when((F.col("node") == F.col("lead")) & (F.col("blocks") > 1), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(block))
    rows = met.select("node", F.explode(F.transform(own, lambda k: F.xxhash64("band", k))).alias("task"))
    columns = ["task", "side", "node", "family", "sign"]
    rows = rows.join(signs, F.col("node") == F.col("_n")).withColumns({"side": F.lit(0), "family": F.col("node")})
    found = _tasks(rows, parts, columns, _connect)
    wide = met.where("blocks > 1")
    if not wide.limit(1).count():
        return found
    family = components(found.select("a", "b").distinct()).select(F.col("node").alias("_f"), "component")
    wide = cut(wide.join(family, F.col("node") == F.col("_f"), "left").select("node", "band", "blocks", F.coalesce("component", "node").alias("family")))
    most = wide.groupBy("band", "family").count().groupBy(F.col("band").alias("_b")).agg(F.max_by("family", "count").alias("most"), F.sum("count").alias("all"), F.max("count").alias("own"))
    most = most.where(F.col("own") < F.col("all")).withColumn("strays", F.ceil((F.col("all") - F.col("own")) / BUCKET).cast("int"))
    j = wide.join(most, F.col("band") == F.col("_b")).withColumn("block", block)
    stray = F.pmod(F.xxhash64(F.lit(4), "node"), F.col("strays")).cast("int")
    at = lambda i, k, side: F.struct(F.xxhash64("band", i, F.lit(-1), k).alias("task"), F.lit(side).alias("side"))
    to_all = F.transform(F.sequence(F.lit(0), F.col("strays") - 1), lambda i: at(i, F.col("block"), 1))
    to_strays = F.when(F.col("family") != F.col("most"), F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: at(stray, k, 0)))
    again = j.select("node", "family", F.explode(F.concat(to_all, F.coalesce(to_strays, F.array().cast("array<struct<task:bigint,side:int>>")))).alias("x"))
    again = again.select("node", "family", "x.task", "x.side").join(signs, F.col("node") == F.col("_n"))
    return found.unionByName(_tasks(again, parts, columns, _connect))


def classes(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents (_id, _row, node), written, and the nodes (node, copies, n_links, class): see `link`."""
    parts = partitions_of(docs)
    raw = docs.select(F.col("doc_id").cast("long").alias("i"), F.xxhash64("doc_id", text).alias("r"), F.coalesce(text, F.lit("")).cast("binary").alias("t"))
    with arrow_batches(docs.sparkSession, 1000):
        rows = cut(raw.mapInPandas(_documents, "_id long, _row long, node long, size int, sign binary"))
        known = rows.where(F.col("node").isNotNull())
        nodes = cut(known.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("sign").alias("sign")))
        family = components(candidates(nodes, parts).select("a", "b").distinct())
        members = nodes.join(family.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n")).withColumn("cls", size_class(F.col("size"))).drop("_n")
        members = cut(members)
        found = _tasks(_verification(docs, members, text), parts, ["task", "side", "node", "copies", "sign", "set"], _verify)
    links = found.where("n > 0").groupBy(F.col("a").alias("_ln")).agg(F.sum("n").alias("links"))
    named = components(found.where("n = 0").select("a", "b")).withColumnsRenamed({"node": "_cn", "component": "_class"})
    out = nodes.select("node", "copies").join(links, F.col("node") == F.col("_ln"), "left").join(named, F.col("node") == F.col("_cn"), "left")
    return rows, cut(out.select("node", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("_class", "node").alias("class")))


def _verification(docs: DataFrame, members: DataFrame, text: str) -> DataFrame:
    """Members with their sets, once for each pair of blocks of their family in which they are compared."""
    counts = members.groupBy("component", "cls").agg(F.ceil(F.greatest(F.sqrt(F.count(F.lit(1)) / BLOCK), F.sum("size") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    blocks = counts.select(F.col("component").alias("_f"), F.col("cls").alias("_c"), "blocks")
    placed = members.join(blocks, (F.col("component") == F.col("_f")) & (F.col("cls") == F.col("_c"))).withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int"))
    upper = blocks.select(F.col("_f").alias("_uf"), (F.col("_c") - 1).alias("_uc"), F.col("blocks").alias("above"))
    lower = blocks.select(F.col("_f").alias("_lf"), (F.col("_c") + 1).alias("_lc"), F.col("blocks").alias("under"))
    placed = placed.join(upper, (F.col("component") == F.col("_uf")) & (F.col("cls") == F.col("_uc")), "left")
    placed = placed.join(lower, (F.col("component") == F.col("_lf")) & (F.col("cls") == F.col("_lc")), "left")
    pair = lambda c1, i, c2, j: F.xxhash64("component", c1, i, c2, j)
    one = lambda n: F.sequence(F.lit(0), n - 1)
    at = lambda task, side: F.struct(task.alias("task"), F.lit(side).alias("side"))
    own = F.transform(one(F.col("blocks")), lambda j: at(pair(F.col("cls"), F.least("block", j), F.col("cls"), F.greatest("block", j)), 0).withField("side", F.when(j < F.col("block"), 1).otherwise(0)))
    # larger sets are the second side of a task with the class below, the first with the class above
    up = F.when(F.col("above").isNotNull(), F.transform(one(F.col("above")), lambda j: at(pair(F.col("cls"), F.col("block"), F.col("cls") + 1, j), 0))).otherwise(F.array().cast("array<struct<task:bigint,side:int>>"))
    down = F.when(F.col("under").isNotNull(), F.transform(one(F.col("under")), lambda j: at(pair(F.col("cls") - 1, j, F.col("cls"), F.col("block")), 1))).otherwise(F.array().cast("array<struct<task:bigint,side:int>>"))
    with_sets = placed.select("node", "copies", "sign", F.concat(own, up, down).alias("tasks")).join(_sets_of(docs, members, text), F.col("node") == F.col("_sn"))
    return with_sets.select(F.explode("tasks").alias("x"), "node", "copies", "sign", "set").select("x.task", "x.side", "node", "copies", "sign", "set")


def _looked_up(rows: DataFrame, key: str, table: DataFrame, table_key: str, weight: str, spread: Column, total: int) -> DataFrame:
    """`rows` left joined to `table` (one row a key, `weight`: how many of the rows have it).

    Keys with over 1 / HOT_KEYS of the rows, which are fewer than HOT_KEYS, are broadcast and their rows dealt by `spread`,
    so that no task gets all rows of one key.
    """
    most = max(1000, total // HOT_KEYS)
    values = [c for c in table.columns if c != table_key]
    hot = F.broadcast(table.where(F.col(weight) > most).select(F.col(table_key).alias("_hk"), F.struct(*values).alias("_hv")))
    rest = table.where(F.col(weight) <= most).select(F.col(table_key).alias("_rk"), F.struct(*values).alias("_rv"))
    j = rows.join(hot, F.col(key) == F.col("_hk"), "left")
    found = F.col("_hk").isNotNull()
    j = j.withColumn("_dealt", F.when(found | F.col(key).isNull(), spread).otherwise(F.col(key)))
    j = j.join(rest, (F.col("_dealt") == F.col("_rk")) & ~found & F.col(key).isNotNull(), "left")
    value = F.coalesce("_hv", "_rv")
    return j.select(*rows.columns, *(value[c].alias(c) for c in values))


def link(docs: DataFrame, text: str = "text") -> DataFrame:
    """For each row of `docs`: doc_id, class_id, n_links.

    `n_links` counts the other rows whose shingle sets have a Jaccard similarity of at least THRESHOLD, copies included;
    `class_id` is the least id of the rows that links connect (null only if all of them are null). A text of one to four
    words is one shingle; null texts and texts without a word link to nothing and are a class of their own, named by their
    own id. Texts are read whole, however long. Repeated rows are copies of each other. Other columns are not read; an
    empty table gives an empty one.
    """
    rows, nodes = classes(docs, text)
    total = rows.count()
    # The least id goes from rows to nodes to classes by partial minima, and back to nodes.
    own = rows.where(F.col("node").isNotNull()).groupBy(F.col("node").alias("_on")).agg(F.min("_id").alias("_least"))
    nodes = nodes.join(own, F.col("node") == F.col("_on"), "left")
    first = nodes.groupBy(F.col("class").alias("_k")).agg(F.min("_least").alias("first"), F.count(F.lit(1)).alias("in_class"))
    named = _looked_up(nodes.select("node", "copies", "n_links", "class"), "class", cut(first), "_k", "in_class", F.col("node"), total)
    named = cut(named.select(F.col("node").alias("_nn"), "copies", "n_links", "first"))
    of = _looked_up(rows.select("_id", "_row", "node"), "node", named, "_nn", "copies", F.xxhash64("_id", "_row", F.lit(7)), total)
    class_id = F.when(F.col("node").isNull(), F.col("_id")).otherwise(F.col("first"))
    return of.select(F.col("_id").alias("doc_id"), class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without all but one row of each class: of least id (null last), then of least hash; of fully equal rows one.

    Classes are those of `link`. Null texts and texts without a word are all kept, whatever repeats; texts are read whole; an
    empty table stays empty; all columns, whatever their names, are kept.
    """
    rows, nodes = classes(docs, text)
    order = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_row").alias("r"))
    own = rows.where(F.col("node").isNotNull()).groupBy(F.col("node").alias("_on")).agg(F.min(order).alias("b"))
    best = own.join(nodes.select("node", "class"), F.col("_on") == F.col("node")).groupBy("class").agg(F.min("b").alias("b"))
    key, kept, nth = (free_name(n, docs) for n in ("_key", "_kept", "_nth"))
    best = best.select(F.struct(F.coalesce("b.i", F.lit(0)).alias("i"), F.col("b.n").alias("n"), F.col("b.r").alias("r")).alias(kept))
    at = F.col("doc_id").cast("long")
    words = F.length(F.translate(F.coalesce(F.col(text), F.lit("")), " \t\n\x0b\f\r", "")) > 0
    keyed = docs.withColumn(key, F.struct(F.coalesce(at, F.lit(0)).alias("i"), at.isNull().alias("n"), F.xxhash64("doc_id", text).alias("r"), words.alias("w")))
    # The texts are shuffled once, by these keys; equal rows meet in the same place.
    same = (F.col(f"{key}.i") == F.col(f"{kept}.i")) & (F.col(f"{key}.n") == F.col(f"{kept}.n")) & (F.col(f"{key}.r") == F.col(f"{kept}.r"))
    joined = keyed.join(best, same, "left")
    ranked = joined.withColumn(nth, F.row_number().over(Window.partitionBy(f"{key}.i", f"{key}.n", f"{key}.r").orderBy(f"{key}.w")))
    return ranked.where(~F.col(f"{key}.w") | (F.col(kept).isNotNull() & (F.col(nth) == 1))).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op4."""
    return link(docs.select("doc_id", "text"))
