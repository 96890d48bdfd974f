"""Numbers that travel between tasks as compressed columns.

Operators over windows, suffixes and n-grams handle many numbers a document. A task packs all that it sends to one
receiver into a single row, column by column, byte plane by byte plane; so a shuffle moves few rows, compactly, and the
receiver works on whole arrays.

Documents are dealt to groups by a hash of their id and text. A group is the sender's unit: small enough for a task's
memory, and the same rows in every pass, so that an answer can refer to a sender's n-th number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import mix64, partitions_of

GROUP, RECEIVER = 5e6, 16e6  # bytes of text behind a sender and a receiver, of tables up to 1 GB
LARGEST = 256e6
NULL_ID = np.int64(2**63 - 1)


def pack(x: np.ndarray) -> bytes:
    """An array as compressed byte planes, high bytes last."""
    x = np.ascontiguousarray(x)
    planes = x.view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return x.dtype.str.encode().ljust(8) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    dtype = np.dtype(data[:8].decode().strip())
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8:]), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype).reshape(-1)


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending unsigned numbers by their differences."""
    return pack(np.diff(x, prepend=x.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    x = unpack(data)
    return np.cumsum(x, dtype=x.dtype)


def pack_common(x: np.ndarray) -> bytes:
    """Numbers of which most are one of three: a code for each, and the others."""
    values, n = np.unique(x, return_counts=True)
    top = np.sort(values[np.argsort(-n, kind="stable")[:3]])
    at = np.minimum(np.searchsorted(top, x), max(0, len(top) - 1))
    codes = np.where(top[at] == x, at, 3).astype(np.uint8) if len(top) else np.zeros(0, dtype=np.uint8)
    return join_blobs([pack(top), pack(codes), pack(x[codes == 3])])


def unpack_common(data: bytes) -> np.ndarray:
    top, codes, others = map(unpack, split_blobs(data))
    out = np.empty(len(codes), dtype=others.dtype)
    for k, v in enumerate(top):
        out[codes == k] = v
    out[codes == 3] = others
    return out


def pack_bits(x: np.ndarray) -> bytes:
    return len(x).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(np.packbits(x).tobytes())


def unpack_bits(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8:]), dtype=np.uint8))[:n].astype(bool)


SPACE = np.isin(np.arange(256), [*range(9, 14), 32])
BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
POWER = np.uint64(0xD6E8FEB86659FD93)  # 3 modulo 4, so that swapped bytes differ
TOGETHER = 1 << 20  # bytes of text hashed at a time


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts (UTF-8), one after another, and how many each text has.

    A word's hash mixes its length and the sum of random numbers for its bytes, weighted by powers for their places.
    """
    flats, counts, part, size = [], [], [], 0
    for i, t in enumerate(texts):
        part.append(t)
        size += len(t) + 1
        if size >= TOGETHER or i + 1 == len(texts):
            h, n = _hashed(part)
            flats.append(h)
            counts.append(n)
            part, size = [], 0
    if not flats:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(flats), np.concatenate(counts)


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    word = ~SPACE[raw]
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edges = np.concatenate([[0], edges])
    starts, length = edges[::2], edges[1::2] - edges[::2]
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, bounds))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    inner, at = raw[word], np.cumsum(length) - length
    powers = np.multiply.accumulate(np.full(int(length.max()), POWER, dtype=np.uint64))
    sums = np.add.reduceat(BYTE[inner] * powers[np.arange(len(inner)) - np.repeat(at, length)], at)
    return mix64(sums ^ (length.astype(np.uint64) << np.uint64(40))), counts


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(x: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n numbers, by doubling; run i starts at i."""
    if len(x) < n:
        return np.zeros(0, dtype=np.uint64)
    out, length, power, at = None, 1, MULTIPLIER, x
    done, rest = 0, n
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:  # append a run of `length` to what stands so far
                if out is None:
                    out = at
                else:
                    m = len(x) - (done + length) + 1
                    out = out[:m] * power + at[done : done + m]
                done += length
            rest >>= 1
            if rest:
                m = len(at) - length
                at = at[:m] * power + at[length : length + m]
                power, length = power * power, length * 2
    return out


def join_blobs(blobs: list[bytes]) -> bytes:
    return b"".join(len(b).to_bytes(4, "little") + b for b in blobs)


def split_blobs(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def sizing(size: int) -> tuple[int, int]:
    """Numbers of groups and of receivers for so many bytes of text.

    Every group may write to every receiver. Both numbers grow with the root of the input until a task's share reaches
    LARGEST, so that messages grow only with the input; beyond 256 GB they grow with its square, and get smaller. Neither
    number depends on how many partitions Spark shuffles into.
    """
    scale = max(1.0, (size / 1e9) ** 0.5)
    return max(24, int(np.ceil(size / min(LARGEST, GROUP * scale)))), max(12, int(np.ceil(size / min(LARGEST, RECEIVER * scale))))


def dealt(docs: DataFrame, groups: int, text: str = "text", flag: Column | None = None) -> DataFrame:
    """`docs` as (_group, _id, _tie, _text[, _flag]): the id, a hash of the text that orders equal ids, and the text's bytes, dealt to so many groups."""
    tie = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    group = F.pmod(F.xxhash64(F.lit(1), "doc_id", text), F.lit(groups)).cast("int")
    narrow = docs.select(group.alias("_group"), F.col("doc_id").cast("long").alias("_id"), tie.alias("_tie"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"), *([] if flag is None else [flag.alias("_flag")]))
    return narrow.repartition(partitions_of(docs), "_group")


def ordered(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """The rows of a group in the order that counts as earlier to later: ids (null last), ties, texts; and which ids are null."""
    null = pdf["_id"].isna().to_numpy()
    ids = np.where(null, NULL_ID, pdf["_id"].fillna(0).astype("int64").to_numpy())
    ties = pdf["_tie"].to_numpy(dtype=np.int64)
    order = np.lexsort((ties, ids))
    texts = pdf["_text"].to_numpy()
    return ids[order], ties[order], [bytes(texts[i]) for i in order], null[order]


def sections(pdf: pd.DataFrame) -> dict[tuple, bytes]:
    """Answers to a group by (kind, from)."""
    return {(r.kind, r.at): bytes(r.data) for r in pdf.itertuples(index=False)}
