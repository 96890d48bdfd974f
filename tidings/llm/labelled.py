"""Bounded labelled samples and calibration, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import crc_mod, mix64


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows_per_class: int) -> DataFrame:
    """At most `rows_per_class` labelled documents of each class: `_id`, `text`, `lang`, `_label`, `_weight`.

    Only label rows for which `learn` (over doc_id) holds are seen. They are taken in the order of a hash of the id, so
    reruns agree; the few ids are broadcast and the texts picked in one scan. `_weight` restores the classes' shares.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("_label")).where(F.col("doc_id").isNotNull() & F.col("_label").isin(0, 1) & learn)
    known = known.groupBy("doc_id").agg(F.max("_label").alias("_label"))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    picked = None
    for value in (0, 1):
        part = known.where(F.col("_label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        weight = counts.get(value, 0) / max(1, min(rows_per_class, counts.get(value, 0)))
        part = part.withColumn("_weight", F.lit(float(weight)))
        picked = part if picked is None else picked.unionByName(part)
    picked = picked.withColumnRenamed("doc_id", "_id")
    texts = docs.select(F.col("doc_id").alias("_doc"), "text", "lang")
    return texts.join(F.broadcast(picked), F.col("_doc") == F.col("_id")).select("_id", "text", "lang", "_label", "_weight")


def held_out(doc_id: Column, m: int, at: int) -> Column:
    return crc_mod(doc_id, m) == at


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weighted logistic regression with intercept by Newton steps on standardised columns; returns plain weights, intercept last."""
    mean, std = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / std, np.ones((len(x), 1))])
    b = np.zeros(z.shape[1])
    w = w / w.mean()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        g = z.T @ (w * (p - y)) / len(y) + l2 * b
        h = (z * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z / len(y) + l2 * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    out = np.empty_like(b)
    out[:-1] = b[:-1] / std
    out[-1] = b[-1] - (b[:-1] * mean / std).sum()
    return out


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def set_aside(ids, m: int) -> np.ndarray:
    """One row in m, by a hash of its id: whatever order or pattern the labels have, both parts see it."""
    return mix64(np.asarray(ids, dtype=np.int64).view(np.uint64)) % np.uint64(m) == 0
