"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.session import shared_dir

#: A word: a run of characters other than space and the controls from tab to carriage return.
#: ``bytes.split()`` without arguments splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
GAP = re.compile(rb"[\x20\x09-\x0D]")

#: Keys of which each has over that part of all rows; so they are fewer than this, and may be broadcast.
HOT_KEYS = 50_000

#: Broadcast a table only if it was counted and is no larger than this.
BROADCAST_ROWS = 50_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names in spark.checkpoint.dir; set an own one only where it is unset."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.checkpoint.dir") is None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))  # an error on a cluster, whose machines share no folder of their own


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from what was written."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_of(df: DataFrame) -> int:
    """Number of partitions to shuffle into, as the session sets it for the size of its data."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Jobs started inside pass at most so many rows to Python at a time: whole texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def n_words(text: Column) -> Column:
    """Words of a text as long; null counts none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of doc_id written as text, modulo m. A null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def join_small(left: DataFrame, right: DataFrame, on: Column, how: str = "left", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join `right`, which is broadcast only if its counted rows stay within `limit`; else both sides shuffle."""
    if right.limit(limit + 1).count() <= limit:
        right = F.broadcast(right)
    return left.join(right, on, how)


def free_name(name: str, *frames: DataFrame) -> str:
    """A column name that none of the tables has, in any case of letters."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit integers (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_pieces(text: bytes, overlap: int, size: int = 1 << 20) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text, some `size` bytes at a time, after up to `overlap` words of before; and how many those are."""
    carry, at = [], 0
    while at < len(text):
        gap = GAP.search(text, at + size) if at + size < len(text) else None
        end = gap.start() if gap else len(text)
        words = carry + text[at:end].split()
        yield words, len(carry)
        carry, at = words[max(0, len(words) - overlap) :], end
