"""Queries over the driver's tables, one or more for each operator, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidings.functions import textify, urls
from tidings.functions.clean import clean_html, normalize_content_urls
from tidings.operators import backfill, catalog, changes, enrich, merge, notices, quality
from tidings.plans import views
from tidings.plans.views import stamp, table
from tidings.session import small_batches
from tidings.streaming import machine

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, d: f(small_batches(spark), d)
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


@query("q01_pending_topk", """
SELECT source, doc_id, sha256(text) AS content_hash, rn FROM (
  SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rn FROM documents d
  WHERE text IS NOT NULL AND text <> '' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) WHERE rn <= 3""")
def q01(spark, d):
    docs = table(spark, d, "documents").where(F.col("text").isNotNull() & (F.col("text") != ""))
    open_ = docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")
    top = changes.latest_by(open_.select("source", "doc_id", "text"), "source", [F.desc("doc_id")], 3)
    return top.select("source", "doc_id", textify.content_hash_expr(F.col("text")).alias("content_hash"), "rn")


@query("q02_content_hash", "SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN NULL ELSE sha256(text) END AS content_hash FROM documents")
def q02(spark, d):
    return table(spark, d, "documents").select("doc_id", textify.content_hash_expr(F.col("text")).alias("content_hash"))


@query("q03_dup_hash_groups", "SELECT sha256(text) AS content_hash, min(doc_id) AS min_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def q03(spark, d):
    hashed = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return changes.repeated(hashed, "content_hash", "doc_id").withColumnRenamed("first", "min_id")


@query("q04_first_wins_dedup", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)")
def q04(spark, d):
    return changes.first_seen(table(spark, d, "documents").select(F.sha2("text", 256).alias("h"), "doc_id"), ["h"], "doc_id").select("doc_id")


@query("q05_per_source_latest", """
SELECT o_custkey, o_orderkey, rn FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""")
def q05(spark, d):
    return changes.latest_by(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", [F.desc("o_orderdate"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rn")


@query("q06_floor_filter", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') >= '1997-03-09' GROUP BY 1")
def q06(spark, d):
    dated = table(spark, d, "orders").withColumn("date", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return dated.where(~changes.too_old(F.col("date"), "1997-03-09")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("q07_window_cutoff", """
SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') >= greatest('1998-07-20', strftime(DATE '1998-08-02' - INTERVAL 14 DAY, '%Y-%m-%d')) AND o_orderkey % 5 <> 0""")
def q07(spark, d):
    state = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.when(F.col("o_orderkey") % 5 == 0, True).alias("isDeleted"))
    return merge.check_window(state, F.lit("1998-08-02").cast("date"), 14, "1998-07-20").select("o_orderkey")


@query("q08_existing_meta_left", """
SELECT a.o_orderkey, b.price AS old_price, b.price IS NULL AS is_new, coalesce(b.price <> a.o_totalprice, false) AS price_changed
FROM orders a LEFT JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 5 <> 0) b USING (o_orderkey)""")
def q08(spark, d):
    orders = table(spark, d, "orders").select(F.lit("s").alias("sourceId"), F.col("o_orderkey").alias("articleNo"), "o_totalprice", F.lit("").alias("date"), F.lit("h").alias("contentHash"))
    price = F.when(F.col("articleNo") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    state = orders.where(F.col("articleNo") % 5 != 0).withColumn("title", price.cast("string"))
    found = changes.classify(orders.withColumn("title", F.col("o_totalprice").cast("string")), state)
    return found.select(
        F.col("articleNo").alias("o_orderkey"), F.col("oldTitle").cast("double").alias("old_price"), (F.col("action") == "new").alias("is_new"), (F.col("action") == "changed").alias("price_changed"))


_CLASSIFIED = """
SELECT d.doc_id, d.source AS source, d.text, d.n_chars, CASE WHEN d.doc_id % 17 = 0 THEN 'old' WHEN d.doc_id % 10 = 0 THEN 'new'
  WHEN d.doc_id % 11 = 0 OR d.doc_id % 7 = 0 THEN 'changed' ELSE 'same' END AS action FROM documents d"""


@query("q09_classify_3way", f"SELECT source, action, count(*) AS n FROM ({_CLASSIFIED}) GROUP BY 1, 2")
def q09(spark, d):
    docs = table(spark, d, "documents")
    found = changes.classify(views.document_items(docs), views.document_state(docs))
    return found.groupBy(F.col("sourceId").alias("source"), "action").agg(F.count(F.lit(1)).alias("n"))


@query("q10_truncated_prefix", """
SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN starts_with(text, '?' || left(text, 15)) ELSE left(text, 15) <> '' END AS cut_short FROM documents""")
def q10(spark, d):
    docs = table(spark, d, "documents")
    i, head = F.col("doc_id"), F.left("text", F.lit(15))
    new = F.when(i % 3 == 0, F.concat(head, F.lit("..."))).when(i % 3 == 1, F.concat(F.lit("?"), head, F.lit("..."))).otherwise(F.concat(head, F.lit("��...")))
    return docs.select("doc_id", changes.title_cut_short(new, F.col("text")).alias("cut_short"))


_PAGES = """
WITH o AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) - 1) // 4)::INT AS page FROM orders),
f AS (SELECT o_custkey, page, bool_and(date < '1996-06-01') AS old, bool_and(o_orderkey % 4 <> 0) AS known FROM o GROUP BY 1, 2),
p AS (SELECT o_custkey, page FROM (SELECT DISTINCT o_custkey FROM orders), range(6) t(page)),
s AS (SELECT p.o_custkey, p.page, max(CASE WHEN f.old IS NULL OR f.old OR (f.known AND p.page > 0) THEN 1 ELSE 0 END) OVER (PARTITION BY p.o_custkey ORDER BY p.page) AS stopped,
  coalesce(max(CASE WHEN f.known AND p.page = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY p.o_custkey ORDER BY p.page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS quiet,
  greatest(stopped, quiet) AS ended
  FROM p LEFT JOIN f ON f.o_custkey = p.o_custkey AND f.page = p.page)
SELECT o_custkey, count(*) AS pages FROM s WHERE ended = 0 GROUP BY 1"""


@query("q11_page_known_stop", _PAGES)
def q11(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("sourceId"), F.col("o_orderkey").alias("articleNo"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderdate")
    nth = F.row_number().over(Window.partitionBy("sourceId").orderBy(F.desc("o_orderdate"), "articleNo")) - 1
    items = orders.withColumn("page", F.floor(nth / 4).cast("int"))
    planned = orders.select("sourceId").distinct().select("sourceId", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("page"))
    read = changes.scanned_pages(items, orders.where(F.col("articleNo") % 4 != 0), planned, floor="1996-06-01")
    return read.groupBy(F.col("sourceId").alias("o_custkey")).agg(F.count(F.lit(1)).alias("pages"))


def _merged(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    state, items = views.document_state(docs), views.document_items(docs)
    act = changes.classify(items, state).where("action <> 'old'")
    full = views.as_notices(act.withColumns({
        "department": F.lit("d"), "content": F.col("text"), "contentText": F.col("text"), "cleanHtml": F.concat("text", F.lit("!")), "cleanMarkdown": F.col("text"),
        "sourceUrl": F.lit("u"), "contentHash": F.sha2(F.concat("text", F.lit("!")), 256), "crawledAt": stamp("2026-04-02 00:00:00"),
    }))
    return merge.merge_notices(state, full.join(act.select("sourceId", "articleNo", "action"), ["sourceId", "articleNo"]))


@query("q12_upsert_merge", f"""
WITH c AS ({_CLASSIFIED})
SELECT doc_id AS article_no, left(text, 40) = title AS own_title, edits, views, hash, failures, crawled FROM (
  SELECT c.*, CASE WHEN doc_id % 7 = 0 AND NOT (action IN ('new', 'changed')) THEN 'old ' || left(text, 40) ELSE left(text, 40) END AS title,
    CASE WHEN action = 'changed' THEN 1 ELSE 0 END AS edits, CASE WHEN action = 'old' THEN n_chars ELSE n_chars + 1 END AS views,
    CASE WHEN action IN ('new', 'changed') THEN sha256(text || '!') WHEN doc_id % 13 = 0 THEN NULL ELSE sha256(text) END AS hash,
    CASE WHEN doc_id % 10 = 0 THEN 0 ELSE (doc_id % 4)::INT END AS failures, CASE WHEN action = 'old' THEN '2026-03-21' ELSE '2026-04-02' END AS crawled
  FROM c WHERE NOT (action = 'old' AND doc_id % 10 = 0))""")
def q12(spark, d):
    m = _merged(spark, d).join(table(spark, d, "documents").select("doc_id", "text"), F.col("articleNo") == F.col("doc_id"))
    return m.select(
        F.col("articleNo").alias("article_no"), (F.left("text", F.lit(40)) == F.col("title")).alias("own_title"), F.size("editHistory").alias("edits"), "views",
        F.col("contentHash").alias("hash"), F.col("consecutiveFailures").alias("failures"), F.date_format("crawledAt", "yyyy-MM-dd").alias("crawled"))


@query("q13_history_tail20", """
SELECT user_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 20 GROUP BY 1""")
def q13(spark, d):
    each = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id"))).alias("all"))
    ids = F.transform(merge.tail(F.col("all"), merge.HISTORY), lambda x: x["event_id"])
    return each.select("user_id", F.size(ids).cast("long").alias("n"), F.array_min(ids).alias("first_id"), F.array_max(ids).alias("last_id"))


@query("q14_touch_update", """
SELECT a.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN a.o_totalprice ELSE a.o_totalprice + 10 END AS price, b.o_orderkey IS NOT NULL AS touched
FROM orders a LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0) b USING (o_orderkey)""")
def q14(spark, d):
    a = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    b = a.where(F.col("o_orderkey") % 3 == 0).select("o_orderkey", (F.col("o_totalprice") + 10).alias("_new"))
    return a.join(b, "o_orderkey", "left").select("o_orderkey", F.coalesce("_new", "o_totalprice").alias("price"), F.col("_new").isNotNull().alias("touched"))


_RUNS = """
SELECT user_id, island, count(*) AS run_length, min(event_id) AS first_id FROM (
  SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
WHERE event_type = 'error' GROUP BY 1, 2"""


@query("q15_failure_runs", f"SELECT user_id, run_length, first_id FROM ({_RUNS}) WHERE run_length >= 3")
def q15(spark, d):
    runs = machine.failure_runs(views.event_outcomes(table(spark, d, "events")))
    return runs.where(F.col("n") >= merge.DELETED_AFTER).select("user_id", F.col("n").alias("run_length"), "first_id")


_STATE = f"""
WITH runs AS ({_RUNS}), u AS (SELECT user_id, count(*) AS n, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS last_island FROM events GROUP BY 1)
SELECT u.user_id, CASE WHEN coalesce(max(run_length), 0) >= 3 THEN 3 ELSE coalesce(max(CASE WHEN island = last_island THEN run_length END), 0) END::INT AS failures,
  coalesce(max(run_length), 0) >= 3 AS is_deleted FROM u LEFT JOIN runs ON runs.user_id = u.user_id GROUP BY u.user_id"""


@query("q16_soft_delete_state", _STATE)
def q16(spark, d):
    return machine.final_states(views.event_outcomes(table(spark, d, "events")))


@query("q17_mass_404_guard", """
SELECT user_id, day FROM (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(*) FILTER (event_type = 'error') AS bad FROM events GROUP BY 1, 2)
WHERE n >= 5 AND bad * 1.0 / n > 0.5""")
def q17(spark, d):
    e = table(spark, d, "events").select(F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("sourceId"), F.when(F.col("event_type") == "error", "notFound").otherwise("same").alias("outcome"))
    found = merge.mass_not_found(e).where("massNotFound")
    return found.select(F.split_part("sourceId", F.lit("|"), F.lit(1)).cast("long").alias("user_id"), F.split_part("sourceId", F.lit("|"), F.lit(2)).alias("day"))


_OUTCOMES = """
SELECT source, CASE WHEN doc_id % 17 = 0 THEN 'notFound' WHEN doc_id % 13 = 0 THEN 'error' WHEN doc_id % 5 = 0 THEN 'backfilled'
  WHEN doc_id % 3 = 0 OR source IN ('src1', 'src2') THEN 'changed' ELSE 'same' END AS outcome FROM documents"""


@query("q18_change_rate_alert", f"""
SELECT source, checked, changed, backfilled, CASE WHEN checked = backfilled THEN 'none' WHEN changed * 1.0 / (checked - backfilled) > 0.8 THEN 'error' WHEN changed * 1.0 / (checked - backfilled) > 0.3 THEN 'warning' ELSE 'none' END AS alert
FROM (SELECT source, count(*) FILTER (outcome IN ('same', 'changed', 'backfilled')) AS checked, count(*) FILTER (outcome = 'changed') AS changed,
  count(*) FILTER (outcome = 'backfilled') AS backfilled FROM ({_OUTCOMES}) GROUP BY 1)""")
def q18(spark, d):
    i = F.col("doc_id")
    outcome = F.when(i % 17 == 0, "notFound").when(i % 13 == 0, "error").when(i % 5 == 0, "backfilled").when((i % 3 == 0) | F.col("source").isin("src1", "src2"), "changed").otherwise("same")
    counted = merge.check_counters(table(spark, d, "documents").select(F.col("source").alias("sourceId"), outcome.alias("outcome")))
    return counted.select(F.col("sourceId").alias("source"), "checked", "changed", "backfilled", "alert")


@query("q19_broadcast_config", """
SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def q19(spark, d):
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sources = places.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("baseUrl"))
    named = notices.with_source(table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("sourceId")), sources)
    return named.groupBy(F.col("_base").alias("r_name"), F.col("_name").alias("n_name")).agg(F.count(F.lit(1)).alias("n"))


@query("q20_unknown_ids", """
SELECT 'part' AS side, p_partkey AS id FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)
UNION ALL SELECT 'customer', c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL SELECT DISTINCT 'order', o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 10 <> 0)""")
def q20(spark, d):
    part, cust = table(spark, d, "part"), table(spark, d, "customer")
    items, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    ids = lambda df, c: df.select(F.col(c).alias("id"))
    sides = {
        "part": (ids(part, "p_partkey"), ids(items, "l_partkey")), "customer": (ids(cust, "c_custkey"), ids(orders, "o_custkey")),
        "order": (ids(orders, "o_custkey"), ids(cust.where(F.col("c_custkey") % 10 != 0), "c_custkey")),
    }
    a, b, c = (changes.unknown_ids(asked, known, "id").select(F.lit(side).alias("side"), "id") for side, (asked, known) in sides.items())
    return a.unionByName(b).unionByName(c)


@query("q21_strategy_histogram", "SELECT c_mktsegment AS segment, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(c_custkey)) AS place FROM customer GROUP BY 1")
def q21(spark, d):
    return catalog.strategy_histogram(table(spark, d, "customer").select(F.col("c_mktsegment").alias("strategy"), F.col("c_custkey").alias("pos"))).withColumnRenamed("strategy", "segment")


@query("q22_two_level_group", """
SELECT r_name, count(*) AS n, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def q22(spark, d):
    j = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lists = catalog.grouped(j.select("r_name", F.col("n_nationkey").alias("pos"), F.col("n_name").alias("name")), "r_name")
    return lists.withColumn("names", F.array_join("names", ","))


@query("q23_listagg_env", "SELECT 'CRAWL_SOURCE_FILTER=' || string_agg(n_name, ',' ORDER BY n_nationkey) AS line FROM nation WHERE n_regionkey <> 3 AND n_nationkey % 2 = 0")
def q23(spark, d):
    even = (F.col("n_nationkey") % 2 == 0).alias("crawlEnabled")
    sources = table(spark, d, "nation").select(F.col("n_nationkey").alias("pos"), F.col("n_name").alias("id"), (F.col("n_regionkey") != 3).alias("crawlAvailable"), even)
    return catalog.filter_line(sources).withColumnRenamed("text", "line")


@query("q24_seed_cap", """
SELECT r_name, count(DISTINCT n_nationkey) AS seeds, count(DISTINCT n_nationkey) <= 3 AS within FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey % 2 = 0 OR n_nationkey % 3 = 0 GROUP BY 1""")
def q24(spark, d):
    i = F.col("n_nationkey")
    lists = table(spark, d, "nation").groupBy("n_regionkey").agg(F.collect_list(F.when(i % 2 == 0, i)).alias("a"), F.collect_list(F.when(i % 3 == 0, i)).alias("b"))
    seeds = catalog.seed_size(F.col("a"), F.col("b"))
    return lists.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).where(seeds > 0).select("r_name", seeds.cast("long").alias("seeds"), (seeds <= 3).alias("within"))


_ATTACHED = """
WITH a AS (SELECT page_id, page_id % 2 = 0 AS board, CASE page_id % 6 WHEN 1 THEN '' WHEN 2 THEN '#' WHEN 3 THEN 'ftp://x/' || page_id ELSE url END AS u1,
  CASE page_id % 5 WHEN 1 THEN ' ' WHEN 2 THEN 'Unknown' WHEN 3 THEN url ELSE 'file.pdf' END AS n1, url AS u2,
  CASE WHEN page_id % 4 = 0 THEN url ELSE 'https://c.example.com/x' END AS u3, regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) AS h FROM pages)"""
_ISSUES = f"""{_ATTACHED}
SELECT "check", sum(n)::BIGINT AS n FROM (
  SELECT 'invalid_scheme' AS "check", count(*) AS n FROM a WHERE page_id % 6 IN (1, 2, 3)
  UNION ALL SELECT 'blank_name', count(*) FROM a WHERE page_id % 5 IN (1, 2)
  UNION ALL SELECT 'name_is_url', count(*) FROM a WHERE page_id % 5 = 3
  UNION ALL SELECT 'missing_referer', 2 * count(*) FROM a WHERE board
  UNION ALL SELECT 'disallowed_host', sum((page_id % 6 NOT IN (1, 2, 3))::INT + 1 + (page_id % 4 = 0)::INT)::BIGINT FROM a WHERE NOT (h LIKE '%example.com')
  UNION ALL SELECT 'duplicate_url', sum((u1 = u2)::INT + (u3 = u2)::INT)::BIGINT FROM a) WHERE n > 0 GROUP BY 1"""


def _checked_pages(spark, d) -> DataFrame:
    sources = spark.createDataFrame([("board", "gnuboard"), ("other", "standard")], "id string, strategy string")
    return quality.check_attachments(views.page_attachments(table(spark, d, "pages")), sources, ["example.com"])


@query("q25_issue_counts", _ISSUES)
def q25(spark, d):
    return quality.issue_counts(_checked_pages(spark, d))


@query("q25b_issue_report", f"""{_ATTACHED}
SELECT count(*) AS notices, 3 * count(*) AS attachments, count(*) FILTER (page_id % 6 IN (1, 2, 3) OR page_id % 5 IN (1, 2, 3) OR board OR NOT (h LIKE '%example.com') OR u1 = u2 OR u3 = u2) AS "withIssues",
  (SELECT sum(n)::BIGINT FROM ({_ISSUES})) AS issues FROM a""")
def q25b(spark, d):
    return quality.report(_checked_pages(spark, d))


@query("q26_host_allowlist", """
SELECT page_id, regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) AS host, regexp_extract(lower(url), '^https?://([^/?#:]+)', 1) LIKE '%example.com' AS allowed FROM pages""")
def q26(spark, d):
    return table(spark, d, "pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.host_allowed(F.col("url"), ["example.com"]).alias("allowed"))


@query("q27_url_parts", r"""
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, regexp_replace(regexp_replace(url, '([?&])ref=[^&]*(&|$)', '\1'), '[?&]$', '') AS without_ref FROM pages""")
def q27(spark, d):
    return table(spark, d, "pages").select("page_id", urls.query_param(F.col("url"), "page").alias("page"), urls.drop_param(F.col("url"), "ref").alias("without_ref"))


@query("q28_digit_extract", r"SELECT page_id, coalesce(try_cast(nullif(regexp_extract(url, '(\d+)', 1), '') AS BIGINT), 0) AS no FROM pages")
def q28(spark, d):
    return table(spark, d, "pages").select("page_id", textify.first_number(F.col("url")).alias("no"))


@query("q29_whitespace_norm", r"""
SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(text, '[\t\x0b\f\r \xa0]+', ' ', 'g'), '\n[\t\x0b\f\r \xa0]+', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), E' \t\n\r\f\v')) AS h FROM documents""")
def q29(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(textify.squeeze_expr(F.col("text")), 256).alias("h"))


@query("q30_json_props", """
SELECT event_type, count(*) FILTER ((props::JSON ->> 'k')::INT >= 50) AS high, sum((props::JSON ->> 'k')::INT)::BIGINT AS total FROM events GROUP BY 1""")
def q30(spark, d):
    e = table(spark, d, "events").withColumn("k", F.from_json("props", "k int")["k"])
    return e.groupBy("event_type").agg(F.count_if(F.col("k") >= 50).alias("high"), F.sum("k").alias("total"))


def _summarised(spark, d) -> DataFrame:
    """Documents as notices; labelled ones have a summary, made of an older text where the label says bad quality."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    j = docs.join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left")
    known = F.col("quality").isNotNull()
    return views.as_notices(j.select(
        F.col("source").alias("sourceId"), F.col("doc_id").alias("articleNo"), F.left("text", F.lit(40)).alias("title"), F.lit("").alias("category"), F.lit("2026-04-01").alias("date"),
        F.col("text").alias("contentText"), F.sha2("text", 256).alias("contentHash"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n_chars")).alias("crawledAt"),
        F.when(known, stamp("2026-04-01 00:00:00")).alias("summaryAt"), F.when(known, F.when(F.col("quality") == 1, F.sha2("text", 256)).otherwise(F.sha2(F.concat("text", F.lit("x")), 256))).alias("summaryContentHash"),
        F.when(F.col("toxic") == 1, 3).alias("summaryFailures")))


@query("q31_stale_summary", "SELECT d.doc_id FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 0 AND l.toxic = 0 AND d.text <> ''")
def q31(spark, d):
    state = _summarised(spark, d)
    return enrich.stale(state, 2**31 - 1).select(F.col("articleNo").alias("doc_id"))


@query("q32_summary_topk", """
SELECT doc_id, source FROM documents d WHERE text <> '' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY n_chars DESC, source, doc_id LIMIT 50""")
def q32(spark, d):
    return enrich.pending(_summarised(spark, d), 50).select(F.col("articleNo").alias("doc_id"), F.col("sourceId").alias("source"))


@query("q33_null_safe_failures", """
SELECT d.doc_id, CASE WHEN d.doc_id % 4 = 0 THEN 0 WHEN d.doc_id % 4 = 1 THEN coalesce(CASE WHEN l.toxic = 1 THEN 3 END, 0) + 1 ELSE CASE WHEN l.toxic = 1 THEN 3 END END::INT AS failures
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q33(spark, d):
    state = _summarised(spark, d)
    i = F.col("articleNo")
    reply = F.when(i % 4 == 0, F.lit('{"summary": "s", "oneLiner": "o", "model": "m"}'))
    done = state.where(i % 4 < 2).select("sourceId", "articleNo", "contentHash", F.from_json(reply, enrich.RESPONSE).alias("response"))
    return enrich.write_summaries(state, done, stamp("2026-04-03 00:00:00")).select(i.alias("doc_id"), F.col("summaryFailures").alias("failures"))


@query("q34_array_predicates", """
SELECT conv_id, count(*) AS turns, bool_or(role = 'assistant' AND length(text) > 500) AS any_long, bool_and(text <> '') AS all_text, count(*) = 0 AS empty FROM conversations GROUP BY 1""")
def q34(spark, d):
    g = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("role", "text")).alias("turns_"))
    t = F.col("turns_")
    return g.select(
        "conv_id", F.size(t).cast("long").alias("turns"), F.exists(t, lambda x: (x["role"] == "assistant") & (F.length(x["text"]) > 500)).alias("any_long"),
        F.forall(t, lambda x: x["text"] != "").alias("all_text"), (F.size(t) == 0).alias("empty"))


@query("q34b_backfill_candidates", """
SELECT page_id FROM pages WHERE CASE WHEN page_id % 6 = 1 THEN '' WHEN page_id % 6 = 2 THEN '#' WHEN page_id % 6 = 3 THEN 'ftp://x/' || page_id ELSE url END LIKE '%/en/%' OR url LIKE '%/en/%'""")
def q34b(spark, d):
    pages = views.page_attachments(table(spark, d, "pages"))
    state = pages.withColumn("attachments", F.transform("attachments", lambda a: a.withField("url", F.replace(a["url"], F.lit("/en/"), F.lit("/download/")))))
    return backfill.download_manager_candidates(state).select(F.col("articleNo").alias("page_id"))


@query("q35_struct_patch", """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'r' || page_id END AS referer FROM pages""")
def q35(spark, d):
    a = views.page_attachments(table(spark, d, "pages")).withColumn("attachments", F.when(F.col("articleNo") % 2 == 0, F.col("attachments")).otherwise(F.transform("attachments", lambda x: x.withField("referer", F.lit("z")))))
    patched = backfill.patch_referer(F.col("attachments"), F.concat(F.lit("r"), F.col("articleNo").cast("string")))
    return a.select(F.col("articleNo").alias("page_id"), F.array_join(F.array_distinct(F.transform(patched, lambda x: x["referer"])), ",").alias("referer"))


@query("q36_size_guard", "SELECT doc_id, strlen(text) <= 5242880 AS fits, strlen(text)::INT AS bytes FROM documents")
def q36(spark, d):
    return table(spark, d, "documents").select("doc_id", textify.within_limit(F.col("text")).alias("fits"), F.octet_length("text").alias("bytes"))


@query("q37_counters_rollup", f"""
WITH c AS ({_CLASSIFIED}), k AS (SELECT source, count(*) FILTER (action = 'new') AS inserted, count(*) FILTER (action = 'changed') AS updated, count(*) FILTER (action IN ('same', 'old')) AS skipped FROM c GROUP BY 1)
SELECT * FROM k UNION ALL SELECT 'total', sum(inserted)::BIGINT, sum(updated)::BIGINT, sum(skipped)::BIGINT FROM k""")
def q37(spark, d):
    docs = table(spark, d, "documents")
    counters = changes.outcome_counters(changes.classify(views.document_items(docs), views.document_state(docs))).drop("errors")
    total = changes.total_counters(counters).select(F.lit("total").alias("sourceId"), "inserted", "updated", "skipped")
    return counters.unionByName(total).withColumnRenamed("sourceId", "source")


@query("q38_clean_html")
def q38(spark, d):
    p = textify.set_apart(table(spark, d, "pages"), "clean", clean_html(F.col("html"), F.col("url")))
    return p.select("page_id", F.length("clean").alias("n_chars"), (~F.col("clean").rlike("<(script|style|nav|footer)")).alias("sanitised"), textify.content_hash_expr(F.col("clean")).alias("content_hash"))


@query("q39_text_from_html")
def q39(spark, d):
    p = textify.set_apart(table(spark, d, "pages"), "clean", clean_html(F.col("html"), F.col("url")))
    p = textify.set_apart(p, "t", textify.text_from_html(F.col("clean")))
    return p.select("page_id", F.length("t").alias("n_chars"), F.sha2("t", 256).alias("h"))


@query("q40_html_to_markdown")
def q40(spark, d):
    p = textify.set_apart(table(spark, d, "pages"), "clean", clean_html(F.col("html"), F.col("url")))
    p = p.withColumn("md", textify.html_to_markdown_udf("clean"))
    return p.select("page_id", F.length("md").alias("n_chars"), F.col("md").contains("****").alias("four_stars"), F.sha2("md", 256).alias("h"))


@query("q41_normalize_urls")
def q41(spark, d):
    p = textify.set_apart(table(spark, d, "pages"), "h", normalize_content_urls(F.col("html"), F.col("url")))
    return p.select("page_id", F.size(F.regexp_extract_all("h", F.lit('href="https?://'), F.lit(0))).alias("absolute"), F.size(F.regexp_extract_all("h", F.lit('href="/'), F.lit(0))).alias("relative"))


@query("q42_page_links", """
SELECT page_id, count(*) AS links, count(*) FILTER (x LIKE '/%') AS rooted, count(*) FILTER (regexp_matches(lower(x), '[.](pdf|hwp|zip|docx?|xlsx?|pptx?|jpe?g|png)$')) AS files
FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS x FROM pages) GROUP BY 1""")
def q42(spark, d):
    links = table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("x"))
    files = F.lower("x").rlike("[.](pdf|hwp|zip|docx?|xlsx?|pptx?|jpe?g|png)$")
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"), F.count_if(F.col("x").startswith("/")).alias("rooted"), F.count_if(files).alias("files"))


@query("q43_md_validator", """
SELECT "check", count(*) AS n FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'space_before_close_emphasis' WHEN 1 THEN 'broken_link' WHEN 2 THEN 'empty_table_header' WHEN 3 THEN 'cross_line_strong' END AS "check" FROM documents)
WHERE "check" IS NOT NULL GROUP BY 1""")
def q43(spark, d):
    i = F.col("doc_id")
    md = F.when(i % 5 == 0, F.lit("a **bold **")).when(i % 5 == 1, F.lit("see [x](http://y")).when(i % 5 == 2, F.lit("| | |\n| --- | --- |\n| a | b |")).when(i % 5 == 3, F.lit("**one\ntwo**")).otherwise(F.lit("**fine** text"))
    return quality.markdown_counts(quality.check_markdown(table(spark, d, "documents").select("doc_id", md.alias("cleanMarkdown"))))


@query("q43b_md_scan")
def q43b(spark, d):
    return quality.report(quality.check_markdown(table(spark, d, "documents").select("doc_id", "text"), "text"))


@query("q44_normalize_date", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN (2026 - CASE WHEN month(o_orderdate) > 4 THEN 1 ELSE 0 END)::VARCHAR || '-' || strftime(o_orderdate, '%m-%d')
  WHEN 1 THEN '20' || strftime(o_orderdate, '%y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders""")
def q44(spark, d):
    i, o = F.col("o_orderkey"), "o_orderdate"
    raw = F.when(i % 3 == 0, F.date_format(o, "MM-dd")).when(i % 3 == 1, F.date_format(o, "yy-MM-dd")).otherwise(F.date_format(o, "yyyy-MM-dd"))
    return table(spark, d, "orders").select("o_orderkey", textify.normalize_date_expr(raw, F.lit("2026-04-15").cast("date")).alias("date"))


@query("q45_stream_failure_machine", _STATE)
def q45(spark, d):
    return machine.streamed_states(spark, d)


@query("q46_stream_windows", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def q46(spark, d):
    return machine.streamed_windows(spark, d)


_UPDATE_CHECK = """
SELECT doc_id, CASE WHEN outcome IN ('changed', 'backfilled') THEN sha256(fetched) WHEN hashed THEN sha256(text) END AS hash,
  CASE WHEN outcome = 'notFound' AND NOT mass THEN f + 1 WHEN outcome IN ('same', 'changed', 'backfilled') THEN 0 ELSE f END::INT AS failures,
  CASE WHEN outcome = 'notFound' AND NOT mass THEN f + 1 >= 3 ELSE false END AS is_deleted, CASE WHEN outcome = 'changed' THEN 1 ELSE 0 END AS edits
FROM (SELECT *, count(*) FILTER (outcome = 'notFound') OVER (PARTITION BY source) * 1.0 / count(*) OVER (PARTITION BY source) > 0.5 AND count(*) OVER (PARTITION BY source) >= 5 AS mass FROM (
  SELECT doc_id, source, text, doc_id % 4 AS f, doc_id % 13 <> 0 AS hashed, CASE WHEN doc_id % 3 = 0 THEN text || '!' ELSE text END AS fetched,
    CASE WHEN doc_id % 17 = 0 OR source = 'src3' THEN 'notFound' WHEN doc_id % 19 = 0 THEN 'error' WHEN doc_id % 13 = 0 THEN 'backfilled' WHEN doc_id % 3 = 0 THEN 'changed' ELSE 'same' END AS outcome
  FROM documents WHERE doc_id % 10 <> 0))"""


@query("q47_update_check", _UPDATE_CHECK)
@query("q47b_update_check_unhashed", _UPDATE_CHECK)
def q47(spark, d):
    return _update_check(views.document_state(table(spark, d, "documents")))


def _update_check(state: DataFrame) -> DataFrame:
    i = F.col("articleNo")
    status = F.when((i % 17 == 0) | (F.col("sourceId") == "src3"), 404).when(i % 19 == 0, 500).otherwise(200)
    new = F.when(i % 3 == 0, F.concat("contentText", F.lit("!"))).otherwise(F.col("contentText"))
    fetched = state.select("sourceId", "articleNo", status.alias("status"), F.sha2(new, 256).alias("newHash"), new.alias("content"), new.alias("contentText"), new.alias("cleanHtml"), new.alias("cleanMarkdown"))
    after = merge.apply_check(state, merge.check_outcomes(state, fetched), stamp("2026-04-02 00:00:00"))
    return after.select(i.alias("doc_id"), F.col("contentHash").alias("hash"), F.col("consecutiveFailures").alias("failures"), F.col("isDeleted").alias("is_deleted"), F.size("editHistory").alias("edits"))
