"""Queries of readers that stay inside SQL: JSON boards by VARIANT, page elements by table functions, and what a run counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions import tables
from tidings.operators import backfill
from tidings.plans import flow_queries, flows
from tidings.plans.queries import query
from tidings.plans.views import stamp, table
from tidings.sources import fetching, json_boards


def _bodies(spark, d, entry, of_rows) -> DataFrame:
    """A page for each customer with orders, of their orders; every seventh is cut off in the middle."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_json(entry).alias("x"))
    pages = o.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "x"))), lambda r: r["x"]), ",").alias("rows"))
    body = of_rows(F.col("rows"))
    return pages.select(F.col("o_custkey").alias("page"), F.when(F.col("o_custkey") % 7 == 0, F.expr("left(rows, length(rows) - 3)")).otherwise(body).alias("body"))


@query("q59_json_bulletins", """
SELECT o_custkey AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, o_orderkey AS no, 'Order ' || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '' END AS category, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '' END AS author,
  strftime(o_orderdate, '%Y-%m-%d') AS date, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 1000 END AS views, 'https://lib/' || o_orderkey AS path,
  CASE o_orderkey % 4 WHEN 0 THEN 'file:https://f/p' || o_orderkey WHEN 1 THEN 'unknown:https://i/img' || o_orderkey ELSE '' END AS files FROM orders WHERE o_custkey % 7 <> 0 AND o_custkey % 11 <> 0""")
def q59(spark, d):
    i, k = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    none = F.lit(None).cast("string")
    file = F.when(i % 4 == 0, F.array(F.struct(F.lit("file").alias("logicalName"), F.concat(F.lit("p"), k).alias("physicalName"), none.alias("originalImageUrl"))))
    file = file.when(i % 4 == 1, F.array(F.struct(none.alias("logicalName"), none.alias("physicalName"), F.concat(F.lit("/img"), k).alias("originalImageUrl"))))
    file = file.when(i % 4 == 2, F.array(F.struct(F.lit("lost").alias("logicalName"), none.alias("physicalName"), none.alias("originalImageUrl"))))
    entry = F.struct(
        i.alias("id"), F.concat(F.lit("Order "), k).alias("title"), F.when(i % 3 == 0, F.struct(F.col("o_orderpriority").alias("name"))).alias("bulletinCategory"), F.when(i % 2 == 0, F.col("o_orderstatus")).alias("writer"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("dateCreated"), F.when(i % 5 != 0, i % 1000).alias("hitCnt"), file.alias("attachments"))
    good = F.when(F.col("o_custkey") % 11 == 0, F.lit("false")).otherwise(F.lit("true"))
    pages = _bodies(spark, d, entry, lambda rows: F.concat(F.lit('{"success":'), good, F.lit(',"data":{"list":['), rows, F.lit("]}}")))
    bases = {"baseUrl": "https://lib", "frontendBase": None, "attachmentBase": "https://f", "imageBase": "https://i"}
    found = json_boards.bulletins(pages.select("*", *(F.lit(v).cast("string").alias(n) for n, v in bases.items())))
    shown = F.array_join(F.transform("attachments", lambda a: F.concat_ws(":", a["name"], a["url"])), ",")
    return found.select("page", F.col("pos").cast("long").alias("pos"), F.col("articleNo").alias("no"), "title", "category", "author", "date", "views", F.col("detailPath").alias("path"), shown.alias("files"))


@query("q59b_json_posts", """
SELECT o_custkey AS page, o_orderkey AS no, 'A & B – <' || o_orderkey || '> é &x; &' AS title, strftime(o_orderdate, '%Y-%m-%d') AS date, CASE WHEN o_orderkey % 3 = 0 THEN '<p>' || o_orderkey || '</p>' END AS content FROM orders WHERE o_custkey % 7 <> 0""")
def q59b(spark, d):
    k = F.col("o_orderkey").cast("string")
    entry = F.struct(
        F.col("o_orderkey").alias("id"), F.struct(F.concat(F.lit("A &amp; B &#8211; &lt;"), k, F.lit("&gt; &#xE9; &x; &")).alias("rendered")).alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.when(F.col("o_orderkey") % 3 == 0, F.struct(F.concat(F.lit("<p>"), k, F.lit("</p>")).alias("rendered"))).alias("content"))
    pages = _bodies(spark, d, entry, lambda rows: F.concat(F.lit("["), rows, F.lit("]")))
    return json_boards.posts(pages).select("page", F.col("articleNo").alias("no"), "title", "date", "content")


@query("q59c_page_elements", r"""
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY k) - 1)::INT AS pos, x[1] AS href, replace(replace(replace(x[2], '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS text
FROM (SELECT page_id, unnest(range(len(l))) AS k, unnest(list_transform(l, lambda y: [regexp_extract(y, '"([^"]*)"', 1), regexp_extract(y, '>([^<]*)<', 1)])) AS x FROM (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS l FROM pages))""")
def q59c(spark, d):
    tables.register(spark)
    return spark.sql("SELECT p.page_id, e.pos, e.href, e.text FROM {pages} p, LATERAL page_elements(p.html, 'a', 'href') e", pages=table(spark, d, "pages"))


@query("q59d_first_links", r"""
SELECT host, href, min(page_id) AS page_id, count(*) AS n FROM (SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, unnest(list_transform(regexp_extract_all(html, '<a href="[^"]*">'), lambda y: regexp_extract(y, '"([^"]*)"', 1))) AS href FROM pages) GROUP BY 1, 2""")
def q59d(spark, d):
    """Of each host's links the page where they come first, by a function over a table that it has dealt and sorted."""
    tables.register(spark)
    links = spark.sql("SELECT p.page_id, regexp_extract(p.url, '^https?://([^/?#]*)', 1) AS host, e.href FROM {pages} p, LATERAL page_elements(p.html, 'a', 'href') e", pages=table(spark, d, "pages"))
    return spark.sql("SELECT host, href, page_id, n FROM first_of_each(TABLE({links}), 'host', 'href', 'page_id')", links=links)


def _flaky(url: str) -> fetching.Answer:
    """A site of which some pages are gone, some always fail, and one host is dead."""
    k = int(url.rpartition("/")[2])
    if url.startswith("https://dead"):
        raise fetching.TimedOut
    return fetching.Answer(404 if k % 11 == 0 else 503 if k % 7 == 0 else 200, url.encode())


class _Time:
    """A clock that goes only when someone waits."""

    def __init__(self):
        self.now = 0.0

    def __call__(self) -> float:
        return self.now

    def wait(self, seconds: float) -> None:
        self.now += seconds


@query("q59e_fetch_rounds", """
SELECT c_custkey AS no, CASE WHEN c_nationkey = 3 THEN 0 WHEN c_custkey % 11 = 0 THEN 404 WHEN c_custkey % 7 = 0 THEN 503 ELSE 200 END AS status, CASE WHEN c_nationkey <> 3 AND (c_custkey % 11 = 0 OR c_custkey % 7 <> 0) THEN 1 ELSE 3 END AS tries FROM customer""")
def q59e(spark, d):
    k, time = F.col("c_custkey"), _Time()
    host = F.when(F.col("c_nationkey") == 3, F.lit("https://dead/")).otherwise(F.concat(F.lit("https://h"), k.cast("string"), F.lit("/")))
    asked = table(spark, d, "customer").select(k.alias("no"), F.concat(host, k.cast("string")).alias("url"))
    answers = fetching.fetch_rounds(asked, lambda: fetching.Once(_flaky, gap=0.0), clock=time, wait=time.wait)
    return answers.select("no", "status", "tries")


_CANDIDATES = "c AS (SELECT c_custkey AS no, 's' || (c_custkey % 25) AS source, CASE WHEN c_custkey % 4 = 0 THEN 'skipped' WHEN c_custkey % 11 = 0 THEN 'failed' WHEN c_custkey % 7 = 0 THEN 'unchanged' ELSE 'updated' END AS outcome FROM customer WHERE c_custkey % 5 = 0)"


def _read_again(spark, d, **limits) -> DataFrame:
    sources = flow_queries.boards(spark)
    found = flows.refetch_changes(sources, flow_queries.refetch_site(spark, d), backfill.empty_attachment_candidates(flow_queries.customer_notices(spark, d)), **limits)
    return found.select(F.col("sourceId").alias("source"), F.col("articleNo").alias("no"), "outcome")


@query("q75d_limit_by_candidates", f"WITH {_CANDIDATES} SELECT source, no, outcome FROM c QUALIFY row_number() OVER (ORDER BY source, no) <= 40")
def q75d(spark, d):
    return _read_again(spark, d, limit=40)


@query("q75e_limit_by_successes", f"WITH {_CANDIDATES} SELECT source, no, outcome FROM c QUALIFY coalesce(count(*) FILTER (outcome = 'updated') OVER (ORDER BY source, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 15")
def q75e(spark, d):
    return _read_again(spark, d, successes=15)


@query("q70b_observed_crawl", flow_queries.TOTALS)
def q70b(spark, d):
    """What a crawl counts while it writes what it found, without a job of its own."""
    seen: dict[str, int] = {}
    flows.crawl_changes(flow_queries.stored(spark, d), flow_queries.boards(spark), flow_queries.site(spark, d), stamp(flow_queries.NOW), "2026-04-15", floor=flow_queries.FLOOR, observed=seen)
    return spark.createDataFrame([tuple(seen[c] for c in ("inserted", "updated", "skipped", "errors"))], "inserted long, updated long, skipped long, errors long")
