"""Queries over a catalogue made from the driver's tables: suppliers as sources, nations as categories, faulty by their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.operators import catalog
from tidings.plans.queries import query
from tidings.plans.views import table
from tidings.session import shared_dir

# Faults by key: 7 no name, 11 unknown kind of board, 13 unknown campus, 17 unknown category, 19 odd reason, 23 repeated id.
_S = """SELECT s_suppkey AS k, CASE WHEN s_suppkey % 23 = 0 AND s_suppkey > 0 THEN 's1' ELSE 's' || s_suppkey END AS id, CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS name,
  CASE WHEN s_suppkey % 11 = 0 THEN 'nope' ELSE (['standard', 'gnuboard', 'pyxis-api', 'wordpress-api'])[(s_suppkey % 4)::INT + 1] END AS strategy,
  CASE WHEN s_suppkey % 13 = 0 THEN 'moon' ELSE (['hssc', 'nsc', 'both'])[(s_suppkey % 3)::INT + 1] END AS campus, CASE WHEN s_suppkey % 5 <> 0 THEN 'college ' || (s_suppkey % 4) END AS college,
  CASE WHEN s_suppkey % 17 = 0 THEN 'zz' ELSE 'n' || s_nationkey END AS cat, s_suppkey % 6 <> 0 AS avail, s_suppkey % 2 = 0 AS enabled,
  CASE WHEN s_suppkey % 19 = 0 THEN 'odd' WHEN s_suppkey % 6 = 0 AND s_suppkey % 12 <> 0 THEN 'noWebsite' END AS reason FROM supplier"""
_C = """SELECT n_nationkey AS k, CASE WHEN n_nationkey = 24 THEN 'n0' ELSE 'n' || n_nationkey END AS id, CASE WHEN n_nationkey % 9 = 8 THEN 'odd' WHEN n_nationkey % 3 = 0 THEN 'fixed' ELSE 'picker' END AS mode,
  CASE WHEN n_nationkey % 12 = 3 THEN NULL WHEN n_nationkey % 12 = 6 THEN 'missing' ELSE 's' || (2 * n_nationkey + 2) END AS fixed, CASE WHEN n_nationkey % 8 <> 1 THEN 2 ELSE 0 END AS most FROM nation"""


def made(spark, d) -> tuple[DataFrame, DataFrame]:
    """The catalogue, written as two JSON files and read as a user's would be."""
    at = shared_dir(spark)
    k, n = F.col("s_suppkey"), F.col("n_nationkey")
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (k % len(xs) + 1).cast("int"))
    source = F.struct(
        F.when((k % 23 == 0) & (k > 0), "s1").otherwise(F.concat(F.lit("s"), k.cast("string"))).alias("id"), F.when(k % 7 != 0, F.col("s_name")).alias("name"),
        F.when(k % 11 == 0, "nope").otherwise(pick("standard", "gnuboard", "pyxis-api", "wordpress-api")).alias("strategy"), F.when(k % 13 == 0, "moon").otherwise(pick("hssc", "nsc", "both")).alias("campus"),
        F.when(k % 5 != 0, F.concat(F.lit("college "), (k % 4).cast("string"))).alias("college"), F.when(k % 17 == 0, "zz").otherwise(F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).alias("appCategory"),
        (k % 6 != 0).alias("crawlAvailable"), (k % 2 == 0).alias("crawlEnabled"), F.when(k % 19 == 0, "odd").when((k % 6 == 0) & (k % 12 != 0), "noWebsite").alias("excludeReason"),
        F.when(k % 4 == 1, F.create_map(F.lit("listRow"), F.lit("tr"))).alias("selectors"))
    no_name = lambda x: F.regexp_replace(x, '"name":null,', "")
    text = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), no_name(F.to_json(source, {"ignoreNullFields": "false"})).alias("j")))), lambda x: x["j"]), ","), F.lit("]"))
    table(spark, d, "supplier").agg(text.alias("value")).coalesce(1).write.text(f"{at}/sources")
    label = F.when(n % 10 == 9, F.to_json(F.struct(F.col("n_name").alias("ko")))).otherwise(F.to_json(F.struct(F.col("n_name").alias("ko"), F.col("n_name").alias("en"))))
    name = F.when(n == 24, "n0").otherwise(F.concat(F.lit("n"), n.cast("string")))
    mode = F.when(n % 9 == 8, "odd").when(n % 3 == 0, "fixed").otherwise("picker")
    fixed = F.when(n % 12 == 3, F.lit("null")).when(n % 12 == 6, F.lit('"missing"')).otherwise(F.concat(F.lit('"s'), (2 * n + 2).cast("string"), F.lit('"')))
    entry = F.format_string('{"id": "%s", "label": %s, "tabMode": "%s", "fixedSourceId": %s, "maxSelection": %d, "defaultIds": ["s2", "s4"], "campusDefaultIds": {"hssc": ["s4", "s6"], "mars": []}}', name, label, mode, fixed, F.when(n % 8 != 1, 2).otherwise(0))
    cats = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(n.alias("k"), entry.alias("j")))), lambda x: x["j"]), ","), F.lit("]"))
    table(spark, d, "nation").agg(cats.alias("value")).coalesce(1).write.text(f"{at}/categories")
    return catalog.read_sources(spark, f"{at}/sources"), catalog.read_categories(spark, f"{at}/categories")


def _by_rule(errors: DataFrame) -> DataFrame:
    return errors.groupBy("entity", "rule").agg(F.count(F.lit(1)).alias("n"))


@query("q60_catalog_scan", f"SELECT row_number() OVER (ORDER BY k) - 1 AS pos, id, name, strategy, cat, avail, reason, name IS NOT NULL AS named FROM ({_S})")
def q60(spark, d):
    sources, _ = made(spark, d)
    return sources.select("pos", "id", "name", "strategy", F.col("appCategory").alias("cat"), F.col("crawlAvailable").alias("avail"), F.col("excludeReason").alias("reason"), F.array_contains("present", "name").alias("named"))


@query("q61_source_rules", f"""
WITH s AS ({_S}), e AS (
  SELECT id AS entity, 'missing_field' AS rule FROM s WHERE name IS NULL
  UNION ALL SELECT id, 'duplicate_id' FROM (SELECT id, row_number() OVER (PARTITION BY id ORDER BY k) AS r FROM s) WHERE r > 1
  UNION ALL SELECT id, 'unknown_strategy' FROM s WHERE strategy = 'nope'
  UNION ALL SELECT id, 'invalid_campus' FROM s WHERE campus = 'moon'
  UNION ALL SELECT id, 'invalid_category' FROM s WHERE cat NOT IN (SELECT id FROM ({_C}))
  UNION ALL SELECT id, 'invalid_reason' FROM s WHERE reason = 'odd'
  UNION ALL SELECT id, 'unavailable_without_reason' FROM s WHERE NOT avail AND reason IS NULL
  UNION ALL SELECT id, 'available_with_reason' FROM s WHERE avail AND reason IS NOT NULL
  UNION ALL SELECT id, 'unavailable_enabled' FROM s WHERE NOT avail AND enabled)
SELECT entity, rule, count(*) AS n FROM e GROUP BY 1, 2""")
def q61(spark, d):
    return _by_rule(catalog.source_errors(*made(spark, d)))


@query("q62_selector_rules", f"""
WITH s AS ({_S}), e AS (
  SELECT id AS entity, 'unknown_strategy' AS rule FROM s WHERE strategy = 'nope'
  UNION ALL SELECT id, 'missing_selectors' FROM s WHERE strategy IN ('standard', 'gnuboard') AND k % 4 <> 1
  UNION ALL SELECT id, 'missing_selector' FROM s, unnest(CASE strategy WHEN 'standard' THEN ['listItem', 'category', 'titleLink', 'infoList', 'detailContent', 'attachmentList'] WHEN 'gnuboard' THEN ['titleLink', 'author', 'date', 'detailContent', 'detailAttachment'] ELSE [] END) WHERE k % 4 = 1
  UNION ALL SELECT id, 'duplicate_id' FROM (SELECT id, row_number() OVER (PARTITION BY id ORDER BY k) AS r FROM s) WHERE r > 1)
SELECT entity, rule, count(*) AS n FROM e GROUP BY 1, 2""")
def q62(spark, d):
    return _by_rule(catalog.selector_errors(made(spark, d)[0]))


@query("q63_category_rules", f"""
WITH s AS ({_S}), c AS ({_C}), f AS (SELECT c.*, s.id AS sid, s.avail FROM c LEFT JOIN s ON s.id = c.fixed WHERE mode = 'fixed'),
p AS (SELECT *, (SELECT count(*) FROM s WHERE s.cat = c.id) AS matched FROM c WHERE mode = 'picker'),
on_ AS (SELECT p.k, p.id, d.x FROM p, (SELECT unnest(['s2', 's4']) AS x) d WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.cat = p.id AND s.id = d.x AND s.avail AND s.enabled)),
on_campus AS (SELECT p.k, p.id, d.x FROM p, (SELECT unnest(['s4', 's6']) AS x) d WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.cat = p.id AND s.id = d.x AND s.avail AND s.enabled)), e AS (
  SELECT 'n0' AS entity, 'duplicate_id' AS rule WHERE (SELECT count(*) FROM c WHERE id = 'n0') > 1
  UNION ALL SELECT id, 'invalid_tab_mode' FROM c WHERE mode = 'odd'
  UNION ALL SELECT id, 'missing_label' FROM c WHERE k % 10 = 9
  UNION ALL SELECT id, 'no_fixed_source' FROM f WHERE fixed IS NULL
  UNION ALL SELECT id, 'unknown_fixed_source' FROM f WHERE fixed IS NOT NULL AND sid IS NULL
  UNION ALL SELECT id, 'unavailable_fixed_source' FROM f WHERE sid IS NOT NULL AND NOT avail
  UNION ALL SELECT id, 'invalid_max_selection' FROM p WHERE most < 1
  UNION ALL SELECT id, 'no_match' FROM p WHERE matched = 0
  UNION ALL SELECT id, 'default_not_enabled' FROM on_
  UNION ALL SELECT id, 'invalid_campus_key' FROM p
  UNION ALL SELECT id, 'campus_default_not_enabled' FROM on_campus
  UNION ALL SELECT id, 'seed_above_max' FROM p WHERE most < 3
  UNION ALL SELECT DISTINCT cat, 'category_without_entry' FROM s WHERE cat NOT IN (SELECT id FROM c))
SELECT entity, rule, count(*) AS n FROM e GROUP BY 1, 2""")
def q63(spark, d):
    sources, categories = made(spark, d)
    return _by_rule(catalog.category_errors(categories, sources))


@query("q64_source_enum", f"""SELECT row_number() OVER (ORDER BY k) - 1 AS pos, upper(replace(id, '-', '_')) || ' = "' || id || '"' AS text FROM ({_S})""")
def q64(spark, d):
    return catalog.source_enum(made(spark, d)[0])


@query("q65_server_sources", f"""SELECT row_number() OVER (ORDER BY k) - 1 AS pos, to_json(struct_pack(id := id, name := name, campus := campus, college := college, appCategory := cat, crawlAvailable := avail, excludeReason := reason,
  hasCategory := CASE WHEN strategy <> 'nope' THEN strategy IN ('standard', 'pyxis-api') END, hasAuthor := CASE WHEN strategy <> 'nope' THEN strategy IN ('standard', 'gnuboard') END))::VARCHAR AS text FROM ({_S})""")
def q65(spark, d):
    return catalog.server_sources(made(spark, d)[0])


@query("q66_server_categories", f"""
SELECT c.k AS pos, c.id, CASE WHEN mode = 'fixed' THEN fixed END AS source, CASE WHEN mode <> 'fixed' THEN coalesce((SELECT string_agg(s.id, ',' ORDER BY s.k) FROM ({_S}) s WHERE s.cat = c.id AND (avail OR reason IS NOT NULL)), '') END AS listed FROM ({_C}) c""")
def q66(spark, d):
    sources, categories = made(spark, d)
    j = catalog.server_categories(categories, sources).withColumn("x", F.from_json("text", "id string, sourceId string, sourceIds array<string>"))
    return j.select("pos", "x.id", F.col("x.sourceId").alias("source"), F.array_join("x.sourceIds", ",").alias("listed"))


@query("q67_coverage", f"SELECT count(*) AS total, count(*) FILTER (avail AND enabled) AS enabled, count(DISTINCT strategy) AS strategies FROM ({_S})")
def q67(spark, d):
    return catalog.coverage(made(spark, d)[0])


_ROW = "'| `' || id || '` | ' || coalesce(name, '') || ' | ' || {campus} CASE WHEN strategy = 'standard' THEN '' ELSE strategy END || ' | ' || CASE WHEN avail AND enabled THEN 'O' ELSE '' END || ' |'"
_LINES = """
WITH s AS ({source}), sections AS (SELECT DISTINCT ord, sec FROM s), lines AS (
  SELECT ord, -5 AS n, '## ' || sec AS text FROM sections UNION ALL SELECT ord, -4, '' FROM sections UNION ALL SELECT ord, -3, '{head}' FROM sections UNION ALL SELECT ord, -2, '{rule}' FROM sections
  UNION ALL SELECT ord, k, {row} FROM s UNION ALL SELECT ord, 1000000000, '' FROM sections
  UNION ALL SELECT '0', 0, '# {title}' UNION ALL SELECT '0', 1, '' UNION ALL SELECT '0', 2, ''{tail})
SELECT row_number() OVER (ORDER BY ord, n)::INT AS pos, text FROM lines"""
_WIDE = {"head": "| id | name | campus | strategy | enabled |", "rule": "| --- | --- | --- | --- | --- |", "row": _ROW.format(campus="coalesce(campus, '') || ' | ' ||")}


@query("q68_college_report", _LINES.format(source=f"SELECT *, CASE WHEN college IS NULL THEN '2' ELSE '1' || college END AS ord, coalesce(college, 'without a college') AS sec FROM ({_S})", title="Sources by college", tail="", **_WIDE))
def q68(spark, d):
    return catalog.college_report(made(spark, d)[0])


@query("q68b_category_report", _LINES.format(
    source=f"""SELECT s.*, '1' || lpad(c.k::VARCHAR, 9, '0') AS ord, CASE WHEN c.k % 10 = 9 THEN '' ELSE c.n_name END || ' (' || c.id || ')' AS sec
    FROM ({_S}) s JOIN (SELECT x.*, n_name FROM ({_C}) x JOIN nation ON n_nationkey = k) c ON s.cat = c.id""", title="Sources by category", tail="", **_WIDE))  # fmt: skip
def q68b(spark, d):
    return catalog.category_report(*made(spark, d))


@query("q68c_coverage_report", _LINES.format(
    source=f"""SELECT *, CASE campus WHEN 'hssc' THEN '1' WHEN 'nsc' THEN '2' WHEN 'both' THEN '3' ELSE '4' END || lpad((min(k) OVER (PARTITION BY campus, part))::VARCHAR, 9, '0') AS ord, campus || ' / ' || part AS sec
    FROM (SELECT *, CASE WHEN campus = 'both' THEN cat ELSE coalesce(college, '-') END AS part FROM ({_S}))""", title="Coverage", head="| id | name | strategy | enabled |", rule="| --- | --- | --- | --- |",
    row=_ROW.format(campus=""), tail=f""" UNION ALL SELECT '9', 0, '- entries: ' || count(*) FROM s UNION ALL SELECT '9', 1, '- enabled: ' || count(*) FROM s WHERE avail AND enabled UNION ALL SELECT '9', 2, '- kinds of boards: ' || count(DISTINCT strategy) FROM s"""))
def q68c(spark, d):
    return catalog.coverage_report(made(spark, d)[0])


@query("q69_by_category", f"""
SELECT cat AS "appCategory", count(*) AS n, string_agg(coalesce(name, '?'), ',' ORDER BY k) AS names FROM ({_S}) GROUP BY 1""")
def q69(spark, d):
    sources, categories = made(spark, d)
    named = sources.withColumn("name", F.coalesce("name", F.lit("?")))
    return catalog.by_category(named, categories).withColumn("names", F.array_join("names", ",")).select("appCategory", "n", "names")
