import datetime as dt
import glob
import os
import random

from pyspark.sql import functions as F

from tidings.operators import merge
from tidings.operators.store import Buckets
from tidings.plans import views
from tidings.schemas import NOTICE
from tidings.streaming import machine

EVENT = "user_id long, event_id long, ts timestamp, failed boolean"


def test_step_freezes_at_the_third_failure():
    state = (0, False)
    for failed, want in ((True, (1, False)), (False, (0, False)), (True, (1, False)), (True, (2, False)), (True, (3, True)), (False, (3, True)), (True, (3, True))):
        state = machine.step(state, failed)
        assert state == want


def test_stream_equals_batch(spark, sf):
    batch = machine.final_states(views.event_outcomes(views.table(spark, sf, "events")))
    assert sorted(map(tuple, machine.streamed_states(spark, sf).collect())) == sorted(map(tuple, batch.collect()))


def test_windows_equal_batch(spark, sf):
    e = views.table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").count()
    got = {(r.day, r.event_type): r.n for r in machine.streamed_windows(spark, sf).collect()}
    assert got == {(r.day, r.event_type): r["count"] for r in e.collect()}


def test_merging_a_stream_is_idempotent(spark, sf, tmp_path):
    docs = views.table(spark, sf, "documents")
    src = str(tmp_path / "obs")
    rows = views.as_notices(views.document_items(docs)).withColumn("action", F.lit("new"))
    rows.repartition(2).write.parquet(src)
    store = Buckets(spark, str(tmp_path / "state"))
    for n in (1, 2):  # the second query sees all rows again
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
        machine.merge_stream(stream, store, merge.merge_notices, str(tmp_path / f"cp{n}")).awaitTermination()
    assert store.read().count() == docs.count() and merge.duplicate_keys(store.read()).count() == 0 and store.read().schema == NOTICE


def test_repeats_are_dropped(spark, tmp_path):
    rows = spark.createDataFrame([("s", 1, "2026-04-01 00:00:00"), ("s", 1, "2026-04-01 01:00:00"), ("s", 2, "2026-04-01 00:00:00")], "sourceId string, articleNo long, t string")
    rows = rows.withColumn("observedAt", F.to_timestamp("t")).drop("t")
    rows.write.parquet(str(tmp_path / "in"))
    out = machine.without_repeats(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    machine.drain(out, "append", lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/b={n}"), str(tmp_path / "cp"))
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out").count() == 2


def at(hour: float) -> dt.datetime:
    return dt.datetime(2026, 4, 1) + dt.timedelta(hours=hour)


def test_summaries_say_what_single_steps_do(spark):
    rng = random.Random(3)
    rows = [(u, k, at(rng.choice([0, 0.1, 1, 5])), rng.random() < 0.6) for u in range(40) for k in range(rng.randrange(1, 12))]
    rows += [(99, k, at(k / 50_000), k % 2 == 0) for k in range(20_000)]  # one user with most of the outcomes
    got = {r.user_id: r for r in machine.run_summaries(spark.createDataFrame(rows, EVENT)).collect()}
    for u in {r[0] for r in rows}:
        outcomes = [f for *_, f in sorted((t, e, f) for x, e, t, f in rows if x == u)]
        r = got[u]
        for start in ((0, False), (1, False), (2, False), (3, True)):
            state = start
            for f in outcomes:
                state = machine.step(state, f)
            assert machine.advanced(start, r.lead, r.most, r.tail, r.good) == state


def in_batches(spark, path, batches, schema):
    """Rows as a stream of one file a batch."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{k}")
        for f in glob.glob(f"{path}/{k}/part*"):
            os.utime(f, (1_000_000 + 1000 * k,) * 2)
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(path))


def told(spark, stream, mode, path, name="x"):
    """What a stream put out, by batch."""
    out = []
    with machine.state_store(spark):
        machine.drain(stream, mode, lambda df, n: out.append([tuple(r) for r in df.collect()]), f"{path}/cp{name}")
    return [sorted(x) for x in out if x]


SUMMARY = "user_id long, lead int, most int, tail int, good boolean, part long"


def test_state_outlives_batches_and_repeated_summaries_count_once(spark, tmp_path):
    batches = [[(1, 2, 2, 2, False, 0), (2, 1, 1, 1, False, 0)], [(1, 2, 2, 2, False, 0), (2, 0, 1, 1, True, 1)], [(1, 1, 1, 0, True, 1), (2, 1, 1, 1, False, 2)]]
    got = told(spark, machine.failure_machine(in_batches(spark, tmp_path / "in", batches, SUMMARY)), "update", tmp_path)
    assert got == [[(1, 2, False, False), (2, 1, False, False)], [(1, 2, False, False), (2, 1, False, False)], [(1, 3, True, False), (2, 2, False, False)]]


def by_steps(spark, path, batches, machine_of):
    """What the machine put out after each batch; the query is started anew for each, on the same checkpoint."""
    out = []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SUMMARY).coalesce(1).write.mode("append").parquet(f"{path}/in")
        out.append([])
        stream = machine_of(spark.readStream.schema(SUMMARY).parquet(f"{path}/in"))
        with machine.state_store(spark):
            query = stream.writeStream.outputMode("update").foreachBatch(lambda df, n: out[-1].extend(sorted(tuple(r) for r in df.collect()))).option("checkpointLocation", f"{path}/cp").trigger(once=True).start()
            assert query.awaitTermination(90)
    return out


def test_state_is_forgotten_after_its_time(spark, tmp_path):
    batches = [[(1, 2, 2, 2, False, 0)], [(1, 1, 1, 1, False, 1)]]
    assert by_steps(spark, tmp_path / "a", batches, lambda x: machine.failure_machine(x, ttl_ms=1))[-1] == [(1, 1, False, False)]
    assert by_steps(spark, tmp_path / "b", batches, lambda x: machine.failure_machine(x, ttl_ms=10**8))[-1] == [(1, 3, True, False)]


def test_a_deleted_notice_is_purged_by_its_timer(spark, tmp_path):
    batches = [[(1, 3, 3, 3, False, 0)], [(2, 1, 1, 1, False, 1)], [(1, 1, 1, 1, False, 2)]]
    got = by_steps(spark, tmp_path, batches, lambda x: machine.failure_machine(x, grace_ms=1))
    assert got[0] == [(1, 3, True, False)] and (1, 3, True, True) in got[1] and got[2] == [(1, 1, False, False)]


SEEN = "sourceId string, articleNo long, observedAt timestamp, title string"


def test_the_newest_observation_wins_whatever_comes_first(spark, tmp_path):
    batches = [[("s", 1, at(2), "b"), ("s", 1, at(1), "a"), ("s", 2, at(1), None)], [("s", 1, at(1.5), "late"), ("s", 2, at(3), "n")], [("s", 1, at(2), "c"), ("s", 2, at(2.5), "older")]]
    got = told(spark, machine.latest_by_key(in_batches(spark, tmp_path / "in", batches, SEEN), "10 hours"), "update", tmp_path)
    assert got == [[("s", 1, at(2), "b"), ("s", 2, at(1), None)], [("s", 2, at(3), "n")], [("s", 1, at(2), "c")]]


def test_old_keys_are_forgotten(spark, tmp_path):
    batches = [[("s", 1, at(2), "b")], [("s", 2, at(100), "x")], [("s", 2, at(101), "y")], [("s", 1, at(100.5), "again")]]
    got = told(spark, machine.latest_by_key(in_batches(spark, tmp_path / "in", batches, SEEN), "1 hour", keep_ms=3_600_000), "update", tmp_path)
    assert got[-1] == [("s", 1, at(100.5), "again")] and len(got) == 4


def test_lists_meet_their_details_within_the_time(spark, tmp_path):
    listed, found = "sourceId string, articleNo long, listedAt timestamp, listDetail string", "sourceId string, articleNo long, detailAt timestamp, detail string"
    items = [[("s", 1, at(0), None), ("s", 2, at(0), None), ("s", 3, at(0), "own"), ("s", 4, at(0), None)], [("s", 9, at(500), None)]]
    details = [[("s", 1, at(1), "one"), ("s", 2, at(5), "too late"), ("s", 3, at(1), "not used")], [("x", 9, at(500), "end")]]
    a, b = in_batches(spark, tmp_path / "l", items, listed), in_batches(spark, tmp_path / "d", details, found)
    got = sorted(x for batch in told(spark, machine.lists_with_details(a, b), "append", tmp_path) for x in batch if x[1] != 9)
    assert got == [("s", 1, at(0), at(1), "one"), ("s", 2, at(0), None, None), ("s", 3, at(0), None, "own"), ("s", 4, at(0), None, None)]
