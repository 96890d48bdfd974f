"""Session settings that the engine's semantics rest on, and run settings from the environment."""

from __future__ import annotations

import json
import logging
import os
import tempfile
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
#: Pages go to Python a few at a time: what a worker holds is several times what it is sent.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return small_batches(spark)


def small_batches(spark: SparkSession) -> SparkSession:
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below the one that all machines share, named by spark.checkpoint.dir. Only a local session may go without."""
    conf = spark.sparkContext.getConf()
    shared = conf.get("spark.checkpoint.dir")
    if shared is None and not (conf.get("spark.master") or "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{(shared or tempfile.mkdtemp(prefix='tidings-')).rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder, read again: computed once, and safe from lost executors."""
    at = shared_dir(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


class Watch:
    """Counts over a table's rows, taken while its next job computes them, so that counting takes no job of its own."""

    def __init__(self, **counts: Column):
        self.columns, self.seen = counts, Observation(f"watch-{uuid.uuid4().hex}")

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *(c.alias(name) for name, c in self.columns.items()))

    def counts(self) -> dict[str, int]:
        """The counts, once that job has run; zeros of a plan that Spark found to be empty."""
        return dict.fromkeys(self.columns, 0) | self.seen.get


def small(df: DataFrame, limit: int = 10_000) -> DataFrame:
    """`df`, marked for broadcast if it was counted and is no larger than that."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def log_counters(event: str, counters: DataFrame | Iterable[Row], logger: logging.Logger | None = None) -> None:
    """One JSON line for each row of a table of counters, which has a row for each source at most."""
    for r in counters.toLocalIterator() if isinstance(counters, DataFrame) else counters:
        (logger or logging.getLogger("tidings")).info(json.dumps({"event": event, **r.asDict(recursive=True)}, default=str, ensure_ascii=False))


@dataclass(frozen=True)
class Config:
    database: str
    ai_url: str | None
    source_filter: tuple[str, ...] | None
    window_days: int = 14
    board_names: tuple[tuple[str, str], ...] = ()  # other names for kinds of boards


def load_config(env: Mapping[str, str] | None = None) -> Config:
    """Settings from an environment map. The database gets a suffix by stage; an empty source list means no filter."""
    env = os.environ if env is None else env
    stage = env.get("APP_ENV", "development")
    suffix = {"production": "", "test": "_test"}.get(stage, "_dev")
    wanted = tuple(x.strip() for x in env.get("CRAWL_SOURCE_FILTER", "").split(",") if x.strip())
    return Config(
        database=env.get("DB_NAME", "notices") + suffix, ai_url=env.get("AI_URL") or None, source_filter=wanted or None,
        window_days=int(env.get("WINDOW_DAYS", "14")), board_names=tuple(tuple(x.strip().split("=", 1)) for x in env.get("BOARD_NAMES", "").split(",") if "=" in x))
