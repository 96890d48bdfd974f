"""Fetching behind a small interface, so that the same plans run on the network and on tables.

A transport answers requests; `Retrying` adds the wait between requests and the tries. In Spark a transport is used inside
`mapInPandas`: each task makes its own from a factory, so nothing but the factory travels.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.urls import host
from tidings.session import small, written

TRIES = 3
GAP = 0.5  # seconds between requests of one task


@dataclass(frozen=True)
class Answer:
    status: int
    body: bytes = b""


class TimedOut(Exception):
    """A transport's way to say that no answer came in time."""


def worth_retrying(problem: Exception | int) -> bool:
    """Only time-outs and server errors."""
    return isinstance(problem, TimedOut) or (isinstance(problem, int) and problem >= 500)


class Retrying:
    """A transport with a least gap between requests and up to TRIES tries, after 1, 2, ... seconds."""

    def __init__(self, transport: Callable[[str], Answer], gap: float = GAP, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.transport, self.gap, self.sleep, self.clock, self.last = transport, gap, sleep, clock, None

    def __call__(self, url: str) -> Answer:
        for k in range(1, TRIES + 1):
            if self.last is not None and (wait := self.gap - (self.clock() - self.last)) > 0:
                self.sleep(wait)
            self.last = self.clock()
            try:
                answer = self.transport(url)
                if not worth_retrying(answer.status) or k == TRIES:
                    return answer
            except TimedOut:
                if k == TRIES:
                    return Answer(0)
            self.sleep(2.0 ** (k - 1))
        raise AssertionError("unreachable")


class Http:
    """A transport over HTTP: `method` and headers as given, redirects followed, at most `most` bytes of the body read."""

    def __init__(self, method: str = "GET", headers: dict[str, str] | None = None, timeout: float = 30.0, most: int = 50_000_000):
        self.method, self.headers, self.timeout, self.most = method, {"User-Agent": "Mozilla/5.0 (compatible; tidings)"} | (headers or {}), timeout, most

    def __call__(self, url: str) -> Answer:
        try:
            request = urllib.request.Request(url, method=self.method, headers=self.headers)
            with urllib.request.urlopen(request, timeout=self.timeout) as r:
                return Answer(200 if r.status == 206 else r.status, r.read(self.most) if self.method != "HEAD" else b"")
        except urllib.error.HTTPError as e:
            return Answer(e.code)
        except TimeoutError as e:
            raise TimedOut from e
        except urllib.error.URLError as e:
            if isinstance(e.reason, TimeoutError):
                raise TimedOut from e
            return Answer(0)
        except (OSError, ValueError):
            return Answer(0)


DEFERRED = -1  # not asked this time: the host gives no answers
DEAD = 3  # failures of a host in a row after which a task asks it no more


class Once:
    """A transport that asks once, with a least gap between requests to a host, and lets a host alone that fails DEAD times in a row.

    What it doesn't get is for a later round (`fetch_rounds`), so no task waits for a retry, nor long for a dead host.
    """

    def __init__(self, transport: Callable[[str], Answer], gap: float = GAP, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.transport, self.gap, self.sleep, self.clock = transport, gap, sleep, clock
        self.last: dict[str, float] = {}
        self.failed: dict[str, int] = {}

    def __call__(self, url: str) -> Answer:
        name = urlsplit(url).netloc.lower() if "//" in url else ""
        if self.failed.get(name, 0) >= DEAD:
            return Answer(DEFERRED)
        if name in self.last and (wait := self.gap - (self.clock() - self.last[name])) > 0:
            self.sleep(wait)
        self.last[name] = self.clock()
        try:
            answer = self.transport(url)
        except TimedOut:
            answer = Answer(TIMED_OUT)
        self.failed[name] = self.failed.get(name, 0) + 1 if answer.status in (0, TIMED_OUT) or worth_retrying(answer.status) else 0
        return answer


TIMED_OUT = -2  # within rounds; an answer that never came counts as 0 in the end


#: Pages; heads of files, for the check that they are there; the first bytes of images, which hold their size.
PAGES: Callable[[], Callable] = lambda: Once(Http())
HEADS: Callable[[], Callable] = lambda: Once(Http("HEAD", timeout=10.0))
IMAGES: Callable[[], Callable] = lambda: Once(Http(headers={"Range": "bytes=0-32767"}, timeout=5.0, most=5_242_880), gap=0.0)


def fetch(requests: DataFrame, make_transport: Callable[[], Callable[[str], Answer]], url: str = "url") -> DataFrame:
    """`requests` with `status` (0: no answer) and `body` (binary) for each row's address; null addresses are not asked for.

    All requests to a host are made by one task, so the gap between them holds for the host.
    """
    names = [c for c in requests.columns if c not in ("status", "body")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        transport = make_transport()
        for b in batches:
            answers = [transport(u) if isinstance(u, str) else Answer(0) for u in b[url]]
            yield b[names].assign(status=[a.status for a in answers], body=[a.body for a in answers])

    kept = requests.select(*names).repartition(host(F.col(url)))
    schema = T.StructType([*kept.schema.fields, T.StructField("status", T.IntegerType()), T.StructField("body", T.BinaryType())])
    return kept.mapInPandas(run, schema)


def fetch_rounds(
    requests: DataFrame, make_transport: Callable[[], Callable[[str], Answer]], url: str = "url", *, tries: int = TRIES,
    clock: Callable[[], float] = time.time, wait: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Like `fetch`, but a failed request is a row with a due time, taken up by a later round; also `tries`, how often it was up.

    Every round asks what is due, once each, and writes the answers, so a lost task repeats its own round only. Time-outs and
    server errors are due again 1, 2, 4, ... seconds later, up to `tries` rounds; so are requests to hosts that a task gave
    up on. Between rounds the driver waits, no task does.
    """
    names = [c for c in requests.columns if c not in ("status", "body", "tries")]
    waiting = written(requests.select(*names).withColumns({"tries": F.lit(0), "_due": F.lit(0.0)}))
    done: list[DataFrame] = []
    while True:
        now = clock()
        due = waiting.where(F.col("_due") <= now)
        answers = written(fetch(due.drop("_due"), make_transport, url).withColumn("tries", F.col("tries") + 1))
        again = F.col(url).isNotNull() & (F.col("status").isin(DEFERRED, TIMED_OUT) | (F.col("status") >= 500)) & (F.col("tries") < tries)
        done.append(answers.where(~again).withColumn("status", F.greatest("status", F.lit(0))))
        later = answers.where(again).select(*names, "tries", (F.lit(now) + F.pow(F.lit(2.0), F.col("tries") - 1)).alias("_due"))
        waiting = written(waiting.where(F.col("_due") > now).unionByName(later))
        next_due = waiting.agg(F.min("_due").alias("t")).first()["t"]
        if next_due is None:
            break
        if (pause := next_due - clock()) > 0:
            wait(pause)
    return reduce(DataFrame.unionByName, done)


FEW = 100_000  # requests that are broadcast


def fetch_from_table(requests: DataFrame, pages: DataFrame, url: str = "url", *, often: bool = False) -> DataFrame:
    """The same from a table of (url, status, body): an address that it lacks answers 404.

    `often`: the table is asked again and again. The requests are counted then, and few of them broadcast, so that only the
    pages which they ask for are shuffled.
    """
    known = pages.select(F.col("url").alias("_u"), F.col("status").alias("_status"), F.col("body").alias("_body"))
    if often:
        asked = requests.select(F.col(url).alias("_u"))
        few = small(asked, FEW)
        known = known if few is asked else known.join(few, "_u", "left_semi")
    known = known.dropDuplicates(["_u"])
    joined = requests.drop("status", "body").join(known, F.col(url) == F.col("_u"), "left")
    return joined.withColumns({"status": F.coalesce("_status", F.lit(404)).cast("int"), "body": F.col("_body").cast("binary")}).drop("_u", "_status", "_body")
