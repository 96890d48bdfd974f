"""Importance resampling towards a target, over bucket-partitioned inverted postings.

Runs of one to three words are hashed into buckets. Documents become postings, inverted: for a range of buckets, the
documents of a block with their counts, bucket by bucket. Postings are shuffled by range and met there by the range's
counts in both corpora; the gain of a bucket is computed where its postings are, and what they contribute to each document
leaves as partial sums, which are reduced by document. Draws then are a rank in the order of perturbed weights.

There are only BUCKETS buckets, so every range holds postings of most documents: ranges are split by a hash of the block
into salts, whose number follows the input; the counts of a range, one row, go to each. No text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.blobs import join_blobs, pack, pack_common, pack_sorted, split_blobs, unpack, unpack_common, unpack_sorted
from tidings.llm.common import arrow_batches, cut, mix64, partitions_of, word_pieces

BUCKETS, LONGEST = 10_000, 3
RANGES = 16
DOCUMENTS, BYTES = 512, 4_000_000  # of a block
SALT = 128e6  # bytes of text behind a salt
LEAST_WORDS, PERCENT, SEED = 20, 5, 42
#: Bytes of a word stay, upper-case ASCII becomes lower-case, all others separate.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
EDGES = np.array([BUCKETS * k // RANGES for k in range(RANGES + 1)])


def features(text: bytes) -> tuple[np.ndarray, int, int]:
    """How often each bucket is met by runs of one to three words, the number of words, and of runs.

    A run's checksum goes on from that of the run without its last word.
    """
    counts, n_words, n = np.zeros(BUCKETS, dtype=np.int64), 0, 0
    for words, old in word_pieces(text.translate(LETTERS), LONGEST - 1):
        sums, fresh = list(map(crc32, words)), []
        for k in range(LONGEST):
            fresh += sums[max(0, old - k) :]
            sums = list(map(crc32, [b" " + w for w in words[k + 1 :]], sums))
        counts += np.bincount(np.array(fresh, dtype=np.int64) % BUCKETS, minlength=BUCKETS)
        n_words += len(words) - old
        n += len(fresh)
    return counts, n_words, n


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        texts, start, size = b["t"].to_list(), 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size > BYTES or i + 1 - start >= DOCUMENTS or i + 1 == len(texts):
                yield b.iloc[start : i + 1]
                start, size = i + 1, 0


def _postings(salts: int):
    """A block of documents as a row of its own (range -1), and a row for each range of buckets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _blocks(batches):
            told = [features(bytes(t)) for t in b["t"]]
            counts = np.stack([c for c, _, _ in told], axis=1)  # a row for each bucket
            null = b["i"].isna().to_numpy()
            tie = b["r"].to_numpy(dtype=np.int64)
            who = [pack(b["i"].fillna(0).to_numpy(dtype=np.int64)), pack(null.astype(np.uint8)), pack(tie)]
            salt = int(mix64(np.array([mix64(tie.view(np.uint64)).sum()], dtype=np.uint64))[0] % np.uint64(salts))
            out = [(-1, salt, join_blobs([*who, pack(np.array([n for _, n, _ in told], dtype=np.int64)), pack(np.array([n for _, _, n in told], dtype=np.int64))]))]
            for k in range(RANGES):
                part = counts[EDGES[k] : EDGES[k + 1]].reshape(-1)
                at = np.flatnonzero(part)  # bucket by bucket, document by document
                out.append((k, salt, join_blobs([*who, pack_sorted(at.astype(np.uint64)), pack_common(part[at].astype(np.uint32))])))
            yield pd.DataFrame(out, columns=["range", "salt", "data"])

    return run


def _read(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one range of a block: its documents (id, null, tie), and bucket, document and count of its postings."""
    ids, null, tie, at, count = split_blobs(data)
    tie = unpack(tie)
    at = unpack_sorted(at).astype(np.int64)
    return (unpack(ids), unpack(null).astype(bool), tie), at // len(tie), at % len(tie), unpack_common(count).astype(np.int64)


def _bucket_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for b in batches:
        for k, data in zip(b["range"], b["data"]):
            _, bucket, _, n = _read(data)
            np.add.at(counts, EDGES[k] + bucket, n)
    some = np.flatnonzero(counts)
    yield pd.DataFrame({"bucket": some, "n": counts[some]})


def _text_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for b in batches:
        for t in b["t"]:
            counts += features(bytes(t))[0]
    some = np.flatnonzero(counts)
    yield pd.DataFrame({"bucket": some, "n": counts[some]})


def gains(s: np.ndarray, t: np.ndarray, all_s: int, all_t: int) -> np.ndarray:
    """What one feature of a bucket gains a document, in thousandths of a nat, rounded down."""
    s, t = s.astype(float), t.astype(float)
    return np.floor(1000 * np.log((t + 1) * (all_s + float(BUCKETS)) / ((s + 1) * (all_t + float(BUCKETS))))).astype(np.int64)


PARTIAL = "_id long, _tie long, weight long, copies long, n_words long, n_features long"


def _partial(ids, null, tie, weight, copies, n_words, n_features) -> pd.DataFrame:
    return pd.DataFrame({"_id": pd.array(np.where(null, 0, ids), dtype="Int64").copy(), "_tie": tie, "weight": weight, "copies": copies, "n_words": n_words, "n_features": n_features}).assign(_id=lambda d: d["_id"].mask(null))


def _contributions(all_s: int, all_t: int):
    def run(key, postings: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros((2, EDGES[key[0] + 1] - EDGES[key[0]]), dtype=np.int64)
        for r in counts["counts"]:
            for x in r:
                own[:, x["bucket"] - EDGES[key[0]]] = x["s"], x["t"]
        gain, out = gains(*own, all_s, all_t), []
        for data in postings["data"]:
            (ids, null, tie), bucket, doc, n = _read(data)
            weight = np.zeros(len(tie), dtype=np.int64)
            np.add.at(weight, doc, n * gain[bucket])
            out.append(_partial(ids, null, tie, weight, 0, 0, 0))
        return pd.concat(out, ignore_index=True) if out else _partial(*np.zeros((3, 0), dtype=np.int64), 0, 0, 0, 0)

    return run


def _heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for data in b["data"]:
            ids, null, tie, n_words, n_features = map(unpack, split_blobs(data))
            yield _partial(ids, null.astype(bool), tie, 0, 1, n_words, n_features)


def weigh(docs: DataFrame, target: DataFrame, *, text: str = "text", target_text: str = "text") -> DataFrame:
    """_id, _tie (a hash of the text), copies, n_words, n_features and weight for each different row of `docs`.

    `weight` sums the gains of all features of the row's text: how much likelier `target` has them than `docs`.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    salts = max(24, int(np.ceil(size / SALT)))
    raw = docs.select(F.col("doc_id").cast("long").alias("i"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("r"), F.coalesce(text, F.lit("")).cast("binary").alias("t"))
    with arrow_batches(docs.sparkSession, 1000):
        rows = cut(raw.mapInPandas(_postings(salts), "range int, salt int, data binary"))
        sought = target.select(F.coalesce(target_text, F.lit("")).cast("binary").alias("t")).mapInPandas(_text_counts, "bucket int, n long")
    postings = rows.where("range >= 0")
    s = postings.mapInPandas(_bucket_counts, "bucket int, n long").withColumn("t", F.lit(0).cast("long")).withColumnRenamed("n", "s")
    t = sought.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    counts = cut(s.unionByName(t).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")))  # BUCKETS rows at most
    total = counts.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    of = sum((F.col("bucket") >= int(e)).cast("int") for e in EDGES[1:-1])
    ranges = counts.groupBy(of.alias("range")).agg(F.collect_list(F.struct("bucket", "s", "t")).alias("counts")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    told = postings.groupBy("range", "salt").cogroup(ranges.groupBy("range", "salt")).applyInPandas(_contributions(*total), PARTIAL)
    told = told.unionByName(rows.where("range < 0").mapInPandas(_heads, PARTIAL))
    reduced = told.groupBy("_id", "_tie").agg(F.sum("weight").alias("weight"), F.sum("copies").alias("copies"), F.max("n_words").alias("n_words"), F.max("n_features").alias("n_features"))
    return reduced.withColumn("weight", F.expr("weight div copies"))  # equal rows contribute alike


def resample(docs: DataFrame, target: DataFrame, *, text: str = "text", target_text: str = "text", percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """For each row of `docs`: doc_id, n_words, n_features, weight, score and rank (1, 2, ... for the rows drawn, else null).

    `score` is the weight with Gumbel noise, which a hash of `seed` and the id gives, so reruns agree; of the rows of at
    least LEAST_WORDS words that percentage with the highest scores is drawn, without replacement, in the order of rank;
    ties go to the smaller id, null last. Null and empty texts have no feature and weigh 0; a null id is hashed like an
    empty one; equal rows weigh alike and are ranked apart. Texts are read whole, however long; an empty table stays empty,
    and an empty target is one without features; other columns are not read.
    """
    w = weigh(docs, target, text=text, target_text=target_text)
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform))).cast("long")
    scored = cut(w.withColumn("score", score).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))))
    n = scored.where(F.col("n_words") >= LEAST_WORDS).count() * percent // 100
    # Ranges of the order are numbered in place, so that no task sorts all; a count for each partition reaches the driver.
    order = [F.col("n_words") < LEAST_WORDS, F.col("score").desc(), F.col("_id").asc_nulls_last(), "_tie", "_copy"]
    placed = scored.repartitionByRange(min(2000, partitions_of(docs)), *order).sortWithinPartitions(*order)
    placed = cut(placed.withColumn("_at", F.monotonically_increasing_id()))
    part, ahead, offsets = F.shiftright("_at", 33), 0, []
    for r in sorted(placed.groupBy(part.alias("p")).count().collect()):
        offsets += [F.lit(r["p"]), F.lit(ahead)]
        ahead += r["count"]
    rank = F.element_at(F.create_map(*offsets), part) + F.col("_at").bitwiseAND((1 << 33) - 1) + 1 if offsets else F.lit(None).cast("long")
    return placed.select(F.col("_id").alias("doc_id"), "n_words", "n_features", "weight", "score", F.when(rank <= n, rank).cast("long").alias("rank"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of query op11."""
    return resample(docs.select("doc_id", "text"), benchmark.select("text")).select("doc_id", "n_features", "weight", "score", "rank")
