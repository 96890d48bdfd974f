"""Recurring ingestion on Structured Streaming: the failure machine, merges by micro-batch, windowed counts."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from contextlib import contextmanager
from datetime import UTC

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener
from pyspark.sql.types import StructType, TimestampType
from pyspark.sql.window import Window

from tidings.operators.merge import DELETED_AFTER
from tidings.operators.store import Buckets
from tidings.schemas import KEY
from tidings.session import shared_dir

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
STATE = "user_id long, failures int, is_deleted boolean"


def failure_runs(outcomes: DataFrame) -> DataFrame:
    """Runs between successes, by number (`_run`): how many failures each has (`n`), and the first of them."""
    run = F.sum(F.when(F.col("failed"), 0).otherwise(1)).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    runs = outcomes.withColumn("_run", run).groupBy("user_id", "_run")
    return runs.agg(F.count_if("failed").alias("n"), F.min(F.when(F.col("failed"), F.col("event_id"))).alias("first_id"))


def final_states(outcomes: DataFrame) -> DataFrame:
    """The machine's last state from all outcomes at once, by runs of failures.

    A notice is deleted at its third failure in a row and not looked at again, so its count stays at three; otherwise the
    count is the length of the run that is still open.
    """
    last = failure_runs(outcomes).groupBy("user_id").agg(F.max("n").alias("most"), F.max_by("n", "_run").alias("open"))
    deleted = F.col("most") >= DELETED_AFTER
    return last.select("user_id", F.when(deleted, DELETED_AFTER).otherwise(F.col("open")).cast("int").alias("failures"), deleted.alias("is_deleted"))


def step(state: tuple[int, bool], failed: bool) -> tuple[int, bool]:
    """One outcome: failures in a row, and deletion, which lasts."""
    n, deleted = state
    if deleted:
        return state
    n = n + 1 if failed else 0
    return n, n >= DELETED_AFTER


def run_summaries(outcomes: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Each user's outcomes as one row: failures before the first success (`lead`) and after the last (`tail`), the longest
    run (`most`), and whether there was a success (`good`).

    Runs are counted by user and hour, so a user with very many outcomes is split; the hours' summaries, few and in order,
    are then joined end to end.
    """
    hour = F.floor(F.unix_timestamp("ts") / slice_seconds)
    sliced = outcomes.withColumn("_slice", hour)
    run = F.sum(F.when(F.col("failed"), 0).otherwise(1)).over(Window.partitionBy("user_id", "_slice").orderBy("ts", "event_id"))
    runs = sliced.withColumn("_run", run).groupBy("user_id", "_slice", "_run").agg(F.count_if("failed").alias("n"))
    part = runs.groupBy("user_id", "_slice").agg(
        F.coalesce(F.max(F.when(F.col("_run") == 0, F.col("n"))), F.lit(0)).alias("lead"), F.max("n").alias("most"), F.max_by("n", "_run").alias("tail"), (F.max("_run") > 0).alias("good"))
    fields = ("lead", "most", "tail", "good")
    parts = F.array_sort(F.collect_list(F.struct("_slice", *fields)))

    def joined(a: Column, b: Column) -> Column:
        met = a["tail"] + b["lead"]
        return F.struct(
            F.when(a["good"], a["lead"]).otherwise(met).alias("lead"), F.greatest(a["most"], b["most"], met).alias("most"),
            F.when(b["good"], b["tail"]).otherwise(met).alias("tail"), (a["good"] | b["good"]).alias("good"))

    none = F.struct(*(F.lit(0).cast("long").alias(f) for f in fields[:3]), F.lit(False).alias("good"))
    whole = F.aggregate(parts, none, joined)
    return part.groupBy("user_id").agg(whole.alias("x")).select("user_id", *(F.col(f"x.{f}").cast("boolean" if f == "good" else "int").alias(f) for f in fields))


def advanced(state: tuple[int, bool], lead: int, most: int, tail: int, good: bool) -> tuple[int, bool]:
    """The state after outcomes of which only the summary is known."""
    n, deleted = state
    if deleted:
        return state
    if max(n + lead, most) >= DELETED_AFTER:
        return DELETED_AFTER, True
    return (tail if good else n + lead), False


class FailureMachine(StatefulProcessor):
    """The machine's state by notice, fed with one summary row a batch.

    A value state holds failures in a row, deletion and the last batch seen, so a summary that comes twice counts once; a
    list state keeps the last summaries. Both are forgotten `ttl_ms` after the last write, if that is set. A notice that is
    marked deleted has a timer: after `grace_ms` it is reported once more, as purged, and forgotten.
    """

    KEPT = 5

    def __init__(self, ttl_ms: int | None = None, grace_ms: int | None = None):
        self.ttl_ms, self.grace_ms = ttl_ms, grace_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "failures int, deleted boolean, part long", self.ttl_ms)
        self.recent = handle.getListState("recent", "part long, lead int, most int, tail int, good boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        now, part = ((0, False), -1)
        if self.now.exists():
            failures, deleted, part = self.now.get()
            now = (failures, deleted)
        was = now[1]
        # one row for each batch that was not seen yet: few, however many outcomes they stand for
        told = sorted({tuple(r) for b in rows for r in b[["part", "lead", "most", "tail", "good"]].itertuples(index=False) if r.part > part})
        for _, *summary in told:
            now = advanced(now, *summary)
        if told:
            self.now.update((int(now[0]), bool(now[1]), int(told[-1][0])))
            kept = [tuple(x) for x in self.recent.get()] if self.recent.exists() else []
            self.recent.put([(int(p), int(a), int(m), int(t), bool(g)) for p, a, m, t, g in [*kept, *told][-self.KEPT :]])
            if now[1] and not was and self.grace_ms is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.grace_ms)
        yield pd.DataFrame({"user_id": [key[0]], "failures": [now[0]], "is_deleted": [now[1]], "purged": [False]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        failures = self.now.get()[0] if self.now.exists() else 0
        self.now.clear()
        self.recent.clear()
        yield pd.DataFrame({"user_id": [key[0]], "failures": [failures], "is_deleted": [True], "purged": [True]})

    def close(self) -> None:
        pass


class Newest(StatefulProcessor):
    """The newest observation of a key: a row goes out each time a newer one comes, however late others arrive.

    `fields` are the observation's, `observedAt` first; of equally new ones the greatest stays. A key is forgotten when the
    watermark has passed its newest observation by `keep_ms`.
    """

    def __init__(self, fields: StructType, keep_ms: int):
        self.fields, self.keep_ms = fields, keep_ms
        self.times = [isinstance(f.dataType, TimestampType) for f in fields]

    def plain(self, values) -> tuple:
        """Values that can be compared: those of the state have times without a zone, those that come have one."""
        return tuple(None if x is None or x != x else x.astimezone(UTC) if is_time else x for x, is_time in zip(values, self.times))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.fields)

    def handleInputRows(self, key, rows, timerValues):
        names = self.fields.names
        now = self.newest.get()
        now = best = None if now is None else self.plain(now)
        for r in rows:
            seen = self.plain(r[n] for n in names)
            if best is None or _order(seen) > _order(best):
                best = seen
        if best is not None and best != now:
            self.newest.update(best)
            if now is None:  # one timer a key: when it is due it looks how new the newest is
                self.handle.registerTimer(_ms(best[0]) + self.keep_ms)
            yield Row(*KEY, *names)(*key, *best)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due = _ms(self.plain(self.newest.get())[0]) + self.keep_ms
        if due > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(due)
        else:
            self.newest.clear()
        yield from ()

    def close(self) -> None:
        pass


def _order(row: tuple) -> tuple:
    """Observations in order: null fields before others, as in Spark."""
    return tuple((x is not None, x) for x in row)


def _ms(t) -> int:
    return int(pd.Timestamp(t).timestamp() * 1000)


@contextmanager
def state_store(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which processors with timers need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def failure_machine(summaries: DataFrame, ttl_ms: int | None = None, grace_ms: int | None = None) -> DataFrame:
    """The machine over a stream of summaries (user_id, part, lead, most, tail, good): the new state of every notice that a batch touches.

    With a time to live or to purge, Spark looks at the clock without end: such a stream is run at an interval, or once, and
    never comes to the end of what is there.
    """
    clock = "None" if ttl_ms is None and grace_ms is None else "ProcessingTime"
    return summaries.groupBy("user_id").transformWithStateInPandas(FailureMachine(ttl_ms, grace_ms), STATE + ", purged boolean", "Update", clock)


def landed(stream: DataFrame, reduce: Callable[[DataFrame], DataFrame], at: str, checkpoint: str, order: str = "part") -> DataFrame:
    """Run a stream to its end, each micro-batch reduced by a plain plan and written with its number; the stream of what was written.

    So a stateful step sees a few rows a key and batch, whatever the stream held. A batch that runs again is written again
    under the same number.
    """
    drain(stream, "append", lambda df, n: reduce(df).withColumn(order, F.lit(n).cast("long")).write.mode("overwrite").parquet(f"{at}/b={n}"), checkpoint)
    spark = stream.sparkSession
    schema = spark.read.option("recursiveFileLookup", "true").parquet(at).schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(at)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


class RunLog(StreamingQueryListener):
    """Logs each micro-batch of the streams it listens to as a JSON line: rows in, what was observed, time, and state rows."""

    def __init__(self, logger: logging.Logger | None = None):
        self.logger = logger or logging.getLogger("tidings")

    def _say(self, event: str, **what) -> None:
        self.logger.info(json.dumps({"event": event, **what}, default=str, ensure_ascii=False))

    def onQueryStarted(self, event) -> None:
        self._say("stream_started", id=event.id, name=event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._say("stream_batch", id=p.id, batch=p.batchId, rows=p.numInputRows, ms=p.batchDuration, state_rows=sum(s.numRowsTotal for s in p.stateOperators), **{k: v.asDict() for k, v in p.observedMetrics.items()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._say("stream_ended", id=event.id, error=event.exception)


def drain(stream: DataFrame, mode: str, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a stream over all that is there, and stop."""
    query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def streamed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The machine run over the events as a stream; each batch's states are written, the latest of each notice read back."""
    at = shared_dir(spark)
    outcomes = read_events(spark, sf_dir).select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("failed"))
    summaries = landed(outcomes, run_summaries, f"{at}/summaries", f"{at}/checkpoint0")
    with state_store(spark):
        drain(failure_machine(summaries), "update", lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{at}/states/b={n}"), f"{at}/checkpoint1")
    states = spark.read.schema(STATE + ", batch long").option("recursiveFileLookup", "true").parquet(f"{at}/states")
    return states.groupBy("user_id").agg(F.max_by(F.struct("failures", "is_deleted"), "batch").alias("s")).select("user_id", "s.failures", "s.is_deleted")


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts and sums by kind, over a stream with a watermark; complete output withholds no window."""
    at = shared_dir(spark)
    events = read_events(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "1 day")
    daily = events.groupBy(F.window("at", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    out = daily.select(F.date_format(F.col("window.start"), "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))
    drain(out, "complete", lambda df, n: df.write.mode("overwrite").parquet(f"{at}/windows"), f"{at}/checkpoint")
    return spark.read.schema("day string, event_type string, n long, total double").parquet(f"{at}/windows")


def merge_stream(observations: DataFrame, store: Buckets, apply: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str, interval: str | None = None):
    """Merge each micro-batch into a table; only the buckets that the batch touches are read and written.

    A batch that is run again, after a failure, is finished or recognised by its number, and not applied twice. The batch must
    have the keys (sourceId, articleNo). One query a table at a time; with no interval it takes what is there and ends.
    """

    def sink(batch: DataFrame, n: int) -> None:
        store.merge(batch, apply, f"{checkpoint}#{n}")

    writer = observations.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def stop_after(query, seconds: float) -> bool:
    """Wait for a stream, and stop it at the deadline: was it done before? What its last batch left undone is done by the next start."""
    done = query.awaitTermination(seconds)
    if not done:
        query.stop()
    return bool(done)


def without_repeats(observations: DataFrame, delay: str = "1 day") -> DataFrame:
    """A stream without repeats of a key within the delay: the first to arrive stays."""
    return observations.withWatermark("observedAt", delay).dropDuplicatesWithinWatermark(list(KEY))


def newest_of(batch: DataFrame) -> DataFrame:
    """Of each key the newest observation, whole; summed up before the shuffle, so one key may have most of the rows."""
    rest = [c for c in batch.columns if c not in (*KEY, "observedAt")]
    return batch.groupBy(*KEY).agg(F.max(F.struct("observedAt", *rest)).alias("x")).select(*KEY, "x.*")


def latest_by_key(observations: DataFrame, delay: str = "1 day", keep_ms: int = 86_400_000) -> DataFrame:
    """A stream of each key's newest observation by `observedAt`, whatever order they come in: a row for each that is newer.

    A key without a newer one is forgotten once the watermark (the newest time less the delay) is `keep_ms` past it. Start
    it under `state_store`. What comes more than the delay late is dropped.
    """
    rest = [f for f in observations.schema if f.name not in (*KEY, "observedAt")]
    fields = StructType([observations.schema["observedAt"], *rest])
    out = StructType([*(observations.schema[k] for k in KEY), *fields])
    keyed = observations.withWatermark("observedAt", delay).groupBy(*KEY)
    return keyed.transformWithState(Newest(fields, keep_ms), out, "Update", "EventTime")


def lists_with_details(lists: DataFrame, details: DataFrame, within: str = "2 hours", delay: str = "1 hour") -> DataFrame:
    """List items joined, as streams, with the details of the same key that come within that time after them.

    `lists`: key, listedAt, listDetail; `details`: key, detailAt, detail. An item that already holds its detail is not
    joined: that detail is used, once. An item whose detail doesn't come goes out without one, when the watermark says
    that none can come any more; a detail that comes later than that is dropped.
    """
    waiting = lists.where(F.col("listDetail").isNull()).withWatermark("listedAt", delay)
    found = details.select(*(F.col(k).alias(f"_{k}") for k in KEY), "detailAt", "detail").withWatermark("detailAt", delay)
    on = [F.col(k) == F.col(f"_{k}") for k in KEY]
    bound = F.expr(f"detailAt >= listedAt AND detailAt <= listedAt + INTERVAL {within}")
    joined = waiting.join(found, [*on, bound], "left_outer")
    rest = [c for c in lists.columns if c != "listDetail"]
    held = lists.where(F.col("listDetail").isNotNull()).select(*rest, F.lit(None).cast("timestamp").alias("detailAt"), F.col("listDetail").alias("detail"))
    return joined.select(*rest, "detailAt", "detail").unionByName(held)
