"""The bucketed table: what a merge writes, what a scan reads, and what a writer that died leaves."""

import os

import pytest
from pyspark.sql import functions as F

from tidings.operators import merge, store
from tidings.plans import views
from tidings.plans.views import stamp
from tidings.schemas import KEY, NOTICE


def notices(spark, n=200, sources=8, action="new", title="t"):
    i = F.col("id")
    rows = spark.range(n).select(
        F.concat(F.lit("s"), (i % sources).cast("string")).alias("sourceId"), i.alias("articleNo"), F.lit(title).alias("title"), F.lit("2026-04-01").alias("date"), i.alias("views"),
        stamp("2026-04-01 00:00:00").alias("crawledAt"), F.sha2(F.concat(F.lit(title), i.cast("string")), 256).alias("contentHash"))
    return views.as_notices(rows).withColumn("action", F.lit(action))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_ino for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def made(spark, path, **more):
    s = store.Buckets(spark, str(path), **more)
    s.merge(notices(spark), merge.merge_notices)
    return s


def test_a_merge_of_one_source_writes_only_its_buckets(spark, tmp_path):
    s = made(spark, tmp_path / "n", buckets=(16, 2))
    before = files(tmp_path / "n/data")
    n = s.merge(notices(spark, action="changed", title="u").where("sourceId = 's3'"), merge.merge_notices)
    after = files(tmp_path / "n/data")
    touched = {os.path.dirname(f) for f in before.keys() ^ after.keys()}
    assert n == 2 == len(touched) and len({d.split("_kb=")[0] for d in touched}) == 1
    got = s.read()
    assert got.schema == NOTICE and got.count() == 200
    assert {(r.sourceId == "s3", r.title, r.editCount) for r in got.collect()} == {(False, "t", 0), (True, "u", 1)}


def test_scans_read_only_the_buckets_that_keys_touch(spark, tmp_path):
    s = made(spark, tmp_path / "n", buckets=(64, 4))
    one = spark.createDataFrame([("s3", 3)], "sourceId string, articleNo long")
    plan = s.of_keys(one)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert s.of_keys(one).where("sourceId = 's3' AND articleNo = 3").count() == 1
    read = s.of_keys(one).select(F.input_file_name().alias("f")).distinct().count()
    assert read == 1 < s._table().select(F.input_file_name().alias("f")).distinct().count()
    some = s.of_sources(spark.createDataFrame([("s3",), ("s5",), ("gone",)], "id string"))
    assert {r.sourceId for r in some.collect()} == {"s3", "s5"} and some.count() == 50


def test_known_keys_of_open_sources(spark):
    keys = store.keys_by_source(notices(spark))
    some = store.of_sources(keys, spark.createDataFrame([("s1",)], "id string"))
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString().lower()
    assert {r.sourceId for r in some.collect()} == {"s1"} and some.count() == 25
    assert len(some.inputFiles()) > 1  # what the pruning leaves out


@pytest.mark.parametrize("dies", ["before", "half", "after"])
def test_a_half_done_merge_is_finished_and_not_applied_twice(spark, tmp_path, monkeypatch, dies):
    s = made(spark, tmp_path / "n", buckets=(8, 2))
    change = notices(spark, action="changed", title="u").where("articleNo < 50")

    def publish(self, ready):
        rows = self._table(f"staged/{ready[0] % 2}")
        if dies == "half":
            rows.where("_sb < 4").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_sb", "_kb").parquet(f"{self.path}/data")
        if dies == "after":
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_sb", "_kb").parquet(f"{self.path}/data")
        raise RuntimeError("died")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(store.Buckets, "_publish", publish)
        s.merge(change, merge.merge_notices, "batch 7")
    again = store.Buckets(spark, str(tmp_path / "n"))
    assert again.buckets == (8, 2)
    assert again.merge(change, merge.merge_notices, "batch 7") == 0
    got = again.read()
    assert got.count() == 200 and merge.duplicate_keys(got).count() == 0
    assert {(r.articleNo < 50, r.title, r.editCount) for r in got.collect()} == {(True, "u", 1), (False, "t", 0)}


def test_empty_tables_and_writes_of_rows(spark, tmp_path):
    s = store.Buckets(spark, str(tmp_path / "n"))
    assert s.read().count() == 0 and not s.recover() and s.merge(notices(spark).limit(0), merge.merge_notices) == 0
    s.write(notices(spark, 10))
    s.write(notices(spark, 20, title="v").where("articleNo >= 8"))
    assert sorted((r.articleNo, r.title) for r in s.read().collect()) == [(i, "t" if i < 8 else "v") for i in range(20)]
    with_null = views.as_notices(spark.createDataFrame([(None, None, "x")], "sourceId string, articleNo long, title string"))
    s.write(with_null)
    assert s.read().where("title = 'x'").count() == 1


def test_the_check_shuffles_no_state_by_source(spark):
    state = notices(spark).drop("action")
    outcomes = state.select(*KEY, F.lit("same").alias("outcome"), F.lit("h").alias("_newHash"))
    plan = merge.apply_check(state, outcomes, stamp("2026-04-02 00:00:00"))._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "hashpartitioning(sourceId" in x and "articleNo" not in x and "title" in x]
