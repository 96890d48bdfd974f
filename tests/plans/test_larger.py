"""Queries over rows that only larger tables have."""

from pyspark.sql import types as T

from tidings.plans import flow_queries, queries  # noqa: F401  they register their queries


def test_reachability_where_pages_share_an_address(spark, tmp_path):
    rows = [(i, "https://a.example.com/x", "") for i in (5, 7, 15, 17, 35)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.QUERIES["q81_reachability"](spark, str(tmp_path))
    assert {r.page_id: r.gone for r in got.collect()} == {5: 2, 7: 0, 15: 1, 17: 0, 35: 2}


def test_summaries_of_all_notices_are_not_brought_to_one_task(spark, sf):
    plan = queries.QUERIES["q79_summary_run"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GlobalLimit" not in plan and "TakeOrdered" not in plan and "SinglePartition" not in plan


def test_newest_by_key_builds_no_frame_for_each_key():
    """Of one key and batch: rows in, rows out, and one timer a key however often a newer one comes."""
    from datetime import UTC, datetime, timedelta

    from pyspark.sql import Row

    from tidings.streaming.machine import Newest

    class Handle:
        value, timers = None, []

        def getValueState(self, *_):
            return self

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

        def registerTimer(self, at):
            self.timers.append(at)

        def getExpiryTimeInMs(self):
            return self.timers[-1]

    handle, first = Handle(), datetime(2026, 1, 1, tzinfo=UTC)
    newest = Newest(T.StructType().add("observedAt", "timestamp").add("n", "long"), 1000)
    newest.init(handle)
    got = [list(newest.handleInputRows(("s", 1), iter([Row(observedAt=first + timedelta(days=k), n=k)]), None)) for k in (1, 2, 0)]
    assert [[r.n for r in rows] for rows in got] == [[1], [2], []] and len(handle.timers) == 1
    assert list(newest.handleExpiredTimer(("s", 1), None, handle)) == [] and handle.value[1] == 2 and len(handle.timers) == 2
    assert list(newest.handleExpiredTimer(("s", 1), None, handle)) == [] and handle.value is None
