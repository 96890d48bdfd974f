"""Made-up sites: an update check makes no list pages, which it never asks for, and few requests or items meet only what they can find."""

from pyspark.sql import functions as F

from tidings.operators import changes
from tidings.plans import flow_queries
from tidings.sources.fetching import fetch_from_table

SF = "/root/testdata/sf0.001"


def test_update_check_makes_no_lists(spark, monkeypatch):
    monkeypatch.setattr(flow_queries, "list_pages", None)
    assert flow_queries.q72(spark, SF).count()


def test_details_alone_answer_as_the_whole_site(spark):
    asked = flow_queries.detail_pages(spark, SF).select("url").limit(50)
    rows = [sorted(map(tuple, site(spark, SF)(asked).select("url", "status", "body").collect())) for site in (flow_queries.site, flow_queries.detail_site)]
    assert rows[0] == rows[1] and len(rows[0]) == 50


def test_few_requests_shuffle_only_the_pages_they_ask_for(spark):
    pages = spark.range(1000).selectExpr("concat('u', id % 900) AS url", "200 AS status", "cast(cast(id % 900 AS string) AS binary) AS body")
    asked = spark.createDataFrame([("u5",), ("u7",), ("u7",), ("gone",), (None,)], "url string")
    rows = [fetch_from_table(asked, pages, often=often) for often in (True, False)]
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in rows]
    assert "LeftSemi" in plans[0] and "strategy=broadcast" in plans[0] and "LeftSemi" not in plans[1]
    got = [sorted(((r.url, r.status, r.body) for r in x.collect()), key=str) for x in rows]
    assert got[0] == got[1] and [r[:2] for r in got[0]] == [("gone", 404), ("u5", 200), ("u7", 200), ("u7", 200), (None, 404)]


def test_few_items_meet_only_their_own_rows_of_the_state(spark, monkeypatch):
    state = spark.range(1000).selectExpr("'s' AS sourceId", "id AS articleNo", "'t' AS title")
    items = spark.createDataFrame([("s", 3), ("s", 3), ("x", 3), ("s", None)], "sourceId string, articleNo long")
    assert [r.articleNo for r in changes.of_keys(state, items).collect()] == [3]
    monkeypatch.setattr(changes, "FEW", 2)
    assert changes.of_keys(state, items) is state


def test_articles_are_sorted_once_for_the_lists(spark):
    plan = flow_queries.list_pages(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 1
    a, lists = flow_queries.articles(spark, SF), flow_queries.list_pages(spark, SF)
    ends = {(r.base, r.page) for r in a.groupBy("base").agg((F.max("page") + 1).alias("page")).collect()}
    empty = lists.where("cast(body AS string) = '<table></table>'").select(F.regexp_extract("url", r"^(.*)\?", 1).alias("base"), (F.regexp_extract("url", r"page=(\d+)", 1).cast("int") - 1).alias("page"))
    assert {(r.base, r.page) for r in empty.collect()} == ends
