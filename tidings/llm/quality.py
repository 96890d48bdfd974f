"""Quality by compression: texts of the kind a dictionary was built from compress better with it.

Two zstandard dictionaries are built from good and from bad labelled texts. Every block of a text is compressed with
each; the difference of the summed sizes, divided by their sum, and the size that the bad dictionary leaves of each byte (tiny
for mere repetition, which neither dictionary tells apart) are turned into a probability by logistic calibration on labelled
texts that no dictionary has seen.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.labelled import held_out, labelled_sample, logistic, set_aside, sigmoid

BLOCK = 2048  # bytes compressed at a time; the dictionary serves each block afresh
LEVEL = 3
DICT_BYTES = 112_640
ROWS_PER_CLASS = 3000  # bound of the labelled sample


def _blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]


def _dictionary(texts: list[str]) -> bytes:
    """A dictionary built from samples of one class; of too few samples, their bytes themselves."""
    blocks = [b for t in texts for b in _blocks(t) if len(b) >= 8]
    try:
        return zstandard.train_dictionary(DICT_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:DICT_BYTES]


class Model:
    """Both dictionaries and the calibration. Made again in each Python worker from its pickled parts."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray):
        self.good, self.bad, self.weights = good, bad, weights
        self._compressors = None

    def __reduce__(self):
        return Model, (self.good, self.bad, self.weights)

    def features(self, text: str | None) -> tuple[float, float]:
        """(bad - good) / (bad + good) of the summed compressed sizes, and log of bad over the text's bytes; zeros for an empty text."""
        if self._compressors is None:
            made = []
            for data in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(data) if data else None
                if d:
                    d.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False) if d else zstandard.ZstdCompressor(level=LEVEL))
            self._compressors = made
        blocks = _blocks(text)
        if not blocks:
            return 0.0, 0.0
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self._compressors)
        return (bad - good) / (bad + good), math.log(bad / sum(map(len, blocks)))

    def score(self, texts) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], dtype=float).reshape(-1, 2)
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def fit(rows: pd.DataFrame) -> Model:
    """Dictionaries from three quarters of the rows, calibration on the rest. Without both classes the score is constant."""
    rows = rows.sort_values("_id", kind="stable").reset_index(drop=True)
    calibrates = set_aside(rows["_id"], 4)
    y = rows["_label"].to_numpy(dtype=float)
    if len(rows) < 8 or len(set(y[calibrates])) < 2 or len(set(y[~calibrates])) < 2:
        return Model(b"", b"", np.array([0.0, 0.0, np.log((y.sum() + 1) / (len(y) - y.sum() + 1))]))
    texts = rows["text"].fillna("")
    model = Model(*(_dictionary(list(texts[~calibrates & (y == v)])) for v in (1.0, 0.0)), np.zeros(3))
    x = np.array([model.features(t) for t in texts[calibrates]])
    model.weights = logistic(x, y[calibrates], rows["_weight"].to_numpy(dtype=float)[calibrates], l2=1e-4)
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Fit on a labelled sample of at most `rows_per_class` rows of each class, in one executor task; only the model reaches the driver."""
    sample = labelled_sample(docs, labels, label, learn, rows_per_class)

    def run(batches):
        yield pd.DataFrame({"model": [pickle.dumps(fit(pd.concat(list(batches) or [pd.DataFrame(columns=["_id", "text", "lang", "_label", "_weight"])])))]})

    parts = sample.repartition(1).mapInPandas(run, "model binary").collect()
    return pickle.loads(parts[0]["model"]) if parts else fit(pd.DataFrame(columns=["_id", "text", "lang", "_label", "_weight"]))


def score_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `quality_score`, the calibrated probability that a text is good, replacing a column of that name.

    The whole of every text is compressed. Null and empty texts have difference 0 and so the score of no evidence; equal
    texts get equal scores; an empty table stays empty; other columns are kept; no shuffle.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.score(texts))

    return docs.withColumn("quality_score", score(F.col(text)))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of query op2. Rows whose id hashes to 1 of 3 are held out of learning."""
    learn = ~held_out(F.col("doc_id"), 3, 1)
    model = train(docs, labels, learn)
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), F.col("quality_score").alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
