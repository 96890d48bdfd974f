"""Summaries: which notices want one, the call, and the write."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.schemas import KEY, PERIOD, struct

MOST_FAILURES = 3
WORK = ("articleNo", "sourceId", "title", "category", "contentText", "contentHash", "date", "crawledAt")
S = T.StringType()
RESPONSE = struct(oneLiner=S, summary=S, type=S, periods=T.ArrayType(PERIOD), locations=T.ArrayType(S), details=T.MapType(S, S), model=S)


def _wanted(state: DataFrame) -> DataFrame:
    text = F.col("contentText").isNotNull() & (F.col("contentText") != "")
    return state.where(text & (F.coalesce("summaryFailures", F.lit(0)) < MOST_FAILURES))


ALL = 2**31 - 1  # the most that a limit can say


def _newest(rows: DataFrame, limit: int) -> DataFrame:
    """So many rows, newest first; where all are wanted they stay where they are, as a limit brings them to one task."""
    if limit >= ALL:
        return rows
    return rows.orderBy(F.desc_nulls_last("crawledAt"), "sourceId", "articleNo").limit(limit)


def pending(state: DataFrame, limit: int = 50) -> DataFrame:
    """Notices with text and no summary, newest first; with the limit `ALL` in no order."""
    return _newest(_wanted(state).where(F.col("summaryAt").isNull()).select(*WORK), limit)


def stale(state: DataFrame, limit: int = 50) -> DataFrame:
    """Notices whose content has changed since their summary."""
    changed = F.col("summaryAt").isNotNull() & ~F.col("summaryContentHash").eqNullSafe(F.col("contentHash"))
    return _newest(_wanted(state).where(changed).select(*WORK), limit)


def stub_summary(title: str, category: str, text: str, date: str) -> dict:
    """A summariser without a model: the first sentence, and the first 200 characters."""
    first = text.strip().split("\n")[0].split(". ")[0][:80]
    kind = "event" if hashlib.sha256(title.encode()).digest()[0] % 2 else "notice"
    return {"oneLiner": first, "summary": text.strip()[:200], "type": kind, "periods": [], "locations": [], "details": None, "model": "stub"}


def patient(client: Callable, tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """A client that tries a failed call again, after 1, 2, ... seconds; the last failure is raised."""

    def call(*args):
        for k in range(tries):
            try:
                return client(*args)
            except Exception:
                if k + 1 == tries:
                    raise
                sleep(2.0**k)
        raise AssertionError("unreachable")

    return call


def summarise(work: DataFrame, make_client: Callable[[], Callable[[str, str, str, str], dict]] = lambda: stub_summary) -> DataFrame:
    """`work` with `response`, null where the call failed. Each task makes its own client."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                try:
                    out.append(client(r.title or "", r.category or "", r.contentText or "", r.date or ""))
                except Exception:  # a failed call is counted, not raised
                    out.append(None)
            yield b[["sourceId", "articleNo", "contentHash"]].assign(response=out)

    schema = T.StructType([T.StructField("sourceId", S), T.StructField("articleNo", T.LongType()), T.StructField("contentHash", S), T.StructField("response", RESPONSE)])
    return work.select(*WORK).mapInPandas(run, schema)


def write_summaries(state: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """State with the summaries; the hash written is that of the text that was read. A failed call adds one failure."""
    new = done.select(F.col("sourceId").alias("_s"), F.col("articleNo").alias("_a"), F.col("contentHash").alias("_h"), F.col("response").alias("_r"))
    j = state.join(new, (F.col("sourceId") == F.col("_s")) & (F.col("articleNo") == F.col("_a")), "left")
    r, ok, failed = F.col("_r"), F.col("_r").isNotNull(), F.col("_s").isNotNull() & F.col("_r").isNull()
    fields = {
        "summary": r["summary"], "summaryOneLiner": r["oneLiner"], "summaryType": F.coalesce(r["type"], F.lit("")), "summaryModel": r["model"],
        "summaryPeriods": F.coalesce(r["periods"], F.array().cast(T.ArrayType(PERIOD))), "summaryLocations": F.coalesce(r["locations"], F.array().cast(T.ArrayType(S))),
        "summaryDetails": r["details"], "summaryContentHash": F.col("_h"), "summaryAt": now,
    }
    out = {c: F.when(ok, v).otherwise(F.col(c)) for c, v in fields.items()}
    out["summaryFailures"] = F.when(ok, 0).when(failed, F.coalesce("summaryFailures", F.lit(0)) + 1).otherwise(F.col("summaryFailures")).cast("int")
    return j.select(*(out.get(c, F.col(c)).alias(c) for c in state.columns))


def summary_counters(done: DataFrame) -> DataFrame:
    return done.agg(F.count_if(F.col("response").isNotNull()).alias("succeeded"), F.count_if(F.col("response").isNull()).alias("failed"))


assert set(KEY) <= set(WORK)
