import datetime

import pytest
from pyspark.sql import functions as F

from tidings.operators import backfill, catalog, changes, enrich, merge, quality
from tidings.plans import flows, queries
from tidings.schemas import ATTACHMENTS, CATEGORY, NOTICE, SOURCE
from tidings.session import load_config
from tidings.sources.fetching import fetch_from_table


def now():
    return F.lit("2026-04-10 00:00:00").cast("timestamp")


def notices(spark, *rows):
    """Notices from dicts; what they lack is null."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in NOTICE) for r in rows], NOTICE)


def base(no, **more):
    return {"sourceId": "s", "articleNo": no, "title": f"t{no}", "date": "2026-04-01", "contentHash": f"h{no}", "content": "c", "editHistory": [], "editCount": 0, "isDeleted": False, "consecutiveFailures": 0, "views": 1, "detailPath": "p"} | more


def incoming(spark, *rows):
    df = notices(spark, *rows)
    actions = spark.createDataFrame([(r["sourceId"], r["articleNo"], r["action"]) for r in rows], "sourceId string, articleNo long, action string")
    return df.join(actions, ["sourceId", "articleNo"])


@pytest.mark.parametrize(("new", "old", "changed"), [
    (("t", "d"), ("t", "d"), False), (("t", "e"), ("t", "d"), True), (("u", "d"), ("t", "d"), True), (("long ti...", "d"), ("long title", "d"), False),
    (("long ti�...", "d"), ("long title", "d"), False), (("other...", "d"), ("long title", "d"), True), (("...", "d"), ("long title", "d"), True), (("�...", "d"), ("x", "d"), True),
])
def test_has_changed(spark, new, old, changed):
    df = spark.createDataFrame([(*new, *old)], "t string, d string, ot string, od string")
    assert df.select(changes.has_changed(*(F.col(c) for c in df.columns))).first()[0] is changed


def test_floor_and_sources(spark):
    df = spark.createDataFrame([("",), (None,), ("2026-03-08",), ("2026-03-09",)], "d string")
    assert [r[0] for r in df.select(changes.too_old(F.col("d"))).collect()] == [False, False, True, False]
    s = spark.createDataFrame([("a", True, True), ("b", True, None), ("c", None, True)], "id string, crawlAvailable boolean, crawlEnabled boolean")
    assert [r.id for r in changes.select_sources(s).collect()] == ["a"] and changes.select_sources(s, ["b", "c"]).count() == 2
    with pytest.raises(ValueError, match="zz"):
        changes.select_sources(s, ["a", "zz"])


def test_merge_history_is_capped_and_merging_twice_changes_nothing_else(spark):
    entry = dict.fromkeys(("detectedAt", "oldHash", "newHash", "oldTitle", "newTitle", "titleChanged", "contentChanged", "source"))
    old = base(1, editHistory=[entry | {"oldHash": str(i)} for i in range(20)], editCount=33, isDeleted=True, consecutiveFailures=2)
    state = notices(spark, old, base(2), base(3))
    new = incoming(spark, base(1, title="new", contentHash="n", action="changed", crawledAt=datetime.datetime(2026, 4, 2)), base(2, views=9, title="ignored", action="same"), base(4, action="new"), base(5, action="same"))
    rows = {r.articleNo: r for r in merge.merge_notices(state, new).collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert len(rows[1].editHistory) == 20 and rows[1].editHistory[-1].newTitle == "new" and rows[1].editHistory[0].oldHash == "1" and rows[1].editCount == 34 and rows[1].isDeleted
    assert rows[2].views == 9 and rows[2].title == "t2" and rows[4].editCount == 0 and rows[4].editHistory == [] and rows[4].isDeleted is False
    once = merge.merge_notices(state, incoming(spark, base(2, title="x", action="new")))
    twice = merge.merge_notices(once, incoming(spark, base(2, title="x", action="new")))
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect())) and merge.duplicate_keys(twice).count() == 0


def test_update_check_branches(spark):
    state = notices(spark, base(1), base(2, contentHash=None), base(3, consecutiveFailures=2), base(4, consecutiveFailures=1), base(5), base(6, consecutiveFailures=None, isDeleted=None))
    schema = "sourceId string, articleNo long, status int, newHash string, content string"
    fetched = spark.createDataFrame([("s", 1, 200, "z", "new"), ("s", 2, 200, "y", "new"), ("s", 3, 404, None, None), ("s", 4, 200, "h4", "c"), ("s", 5, 500, None, None), ("s", 6, 404, None, None)], schema)
    out = merge.check_outcomes(state, fetched)
    assert {r.articleNo: r.outcome for r in out.collect()} == {1: "changed", 2: "backfilled", 3: "notFound", 4: "same", 5: "error", 6: "notFound"}
    rows = {r.articleNo: r for r in merge.apply_check(state, out, now()).collect()}
    assert rows[1].contentHash == "z" and rows[1].content == "new" and rows[1].editCount == 1 and rows[1].editHistory[-1].source == "tier2"
    assert rows[2].contentHash == "y" and rows[2].content == "c" and rows[2].editCount == 0
    assert rows[3].isDeleted and rows[3].consecutiveFailures == 3 and rows[4].consecutiveFailures == 0 and rows[5].consecutiveFailures == 0
    assert rows[6].consecutiveFailures == 1 and rows[6].isDeleted is False
    c = merge.check_counters(out).first()
    assert (c.checked, c.changed, c.backfilled, c.notFound, c.errors, c.alert) == (3, 1, 1, 2, 1, "warning")
    gone = spark.createDataFrame([("s", i, 404, None, None) for i in range(1, 7)], schema)
    kept = merge.apply_check(state, merge.check_outcomes(state, gone), now())
    assert kept.where("isDeleted").count() == 0 and kept.where("consecutiveFailures = 2").count() == 1


def test_update_check_query_covers_notices_without_a_hash(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["q47b_update_check_unhashed"](spark, sf).collect()}
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
        want = {r[0]: r for r in c.execute(queries.ORACLE_SQL["q47b_update_check_unhashed"]).fetchall()}
    assert got == want
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 10 <> 0 AND doc_id % 13 = 0").collect()
    missing = {r.doc_id for r in docs if r.doc_id % 17 == 0 or r.source == "src3" or r.doc_id % 19 == 0}
    assert docs and missing < {r.doc_id for r in docs} <= set(got)
    assert {r.doc_id for r in docs if got[r.doc_id][1] is None} == missing


def test_store_versions(spark, tmp_path):
    store = merge.Store(spark, str(tmp_path / "notices"))
    assert store.version() == 0 and store.read().count() == 0
    assert store.write(notices(spark, base(1))) == 1 and store.write(store.read().unionByName(notices(spark, base(2)))) == 2
    assert store.read().count() == 2 and store.read().schema == NOTICE
    # What a writer that died left behind, with or without files, is passed over and never written over.
    notices(spark, base(9)).write.parquet(str(tmp_path / "notices" / "v3-dead"))
    assert store.version() == 2 and store.read().count() == 2 and store.write(store.read()) == 3 and store.read().count() == 2


def att(*rows):
    return [(r.get("name"), r.get("url"), r.get("referer")) for r in rows]


def test_attachment_checks(spark):
    a = att({"name": "n", "url": ""}, {"name": " ", "url": "#"}, {"name": "UNKNOWN", "url": "ftp://x"}, {"name": "http://z", "url": "http://evilexample.com/a"}, {"name": "n", "url": "https://A.EXAMPLE.com/b", "referer": "r"}, {"name": "n", "url": "https://A.EXAMPLE.com/b", "referer": "r"}, {"name": "n", "url": "https://A.EXAMPLE.com/b", "referer": "r"})
    df = spark.createDataFrame([(a, "gnuboard")], f"a {ATTACHMENTS.simpleString()}, s string")
    found = [(x.check, x.attachment_index) for x in df.select(quality.attachment_issues(F.col("a"), F.col("s"), ["example.com"]).alias("x")).first().x]
    assert found == [
        ("invalid_scheme", 0), ("missing_referer", 0), ("invalid_scheme", 1), ("blank_name", 1), ("missing_referer", 1), ("invalid_scheme", 2), ("blank_name", 2),
        ("missing_referer", 2), ("name_is_url", 3), ("missing_referer", 3), ("duplicate_url", 5), ("duplicate_url", 6)]
    strict = df.select(quality.attachment_issues(F.col("a"), F.lit("x"), ["example.com"], True).alias("x")).first().x
    assert [x.attachment_index for x in strict if x.check == "disallowed_host"] == [3] and not [x for x in strict if x.check == "missing_referer"]
    state = notices(spark, base(1, attachments=a[3:4]), base(2, attachments=[]), base(3))
    sources = spark.createDataFrame([("s", "standard")], "id string, strategy string")
    checked = quality.check_attachments(state, sources, ["example.com"])
    reached = quality.with_reachability(checked, spark.createDataFrame([("http://evilexample.com/a", 500)], "url string, status int"))
    assert checked.count() == 1 and [x.check for x in reached.first().issues] == ["name_is_url", "unreachable"]
    assert quality.report(reached).first().asDict() == {"notices": 1, "attachments": 1, "withIssues": 1, "issues": 2}


@pytest.mark.parametrize(("md", "checks"), [
    ("**a\nb**", ["cross_line_strong"]), ("**a**\n**b**", []), ("**a:** x\n\n**b:** y", []), ("**a **", ["space_before_close_emphasis"]), ("**x**은 **y**", []), ("(**a **", []),
    ("| | |\r\n| --- | --- |\r\n| a | b |", ["empty_table_header"]), ("| a | |\n| --- | --- |", []), ("[a](http://b", ["broken_link"]), ("![a](b)", []), ("", []), (None, []),
])
def test_markdown_checks(md, checks):
    assert [x["check"] for x in quality.markdown_issues(md)] == checks
    assert [x["check"] for x in quality.markdown_issues(md, "error")] == [c for c in checks if c in ("space_before_close_emphasis", "broken_link")]


def test_issue_lines_and_snippets():
    long = "x\n\n**" + "a" * 200 + " **"
    (issue,) = quality.markdown_issues(long)
    assert issue["line"] == 3 and len(issue["snippet"]) == 123 and issue["snippet"].endswith("...")


def test_backfills(spark):
    a = lambda *urls, referer=None: [("n", u, referer) for u in urls]
    state = notices(spark, base(1, attachments=a("x"), detailPath="?wr_id=1"), base(2, attachments=[]), base(3), base(4, attachments=a("x", referer="r")), base(5, attachments=a("h/download/q"), content=None, detailPath=None), base(6, attachments=a("h/download/q?wpdmdl=1")))
    ids = lambda df: sorted(r.articleNo for r in df.collect())
    assert ids(backfill.referer_candidates(state)) == [1, 5, 6] and ids(backfill.empty_attachment_candidates(state)) == [2]
    assert ids(backfill.download_manager_candidates(state)) == [5] and ids(backfill.content_candidates(state)) == [1, 2, 3, 4, 6]
    src = {"id": "s", "strategy": "gnuboard-custom", "baseUrl": "http://h/b", "boardParam": "t", "boardName": "n", "detailMode": "v"}
    sources = spark.createDataFrame([tuple(src.get(f.name) for f in SOURCE)], SOURCE)
    patched = {r.articleNo: r.attachments[0].referer for r in backfill.backfill_referer(state, sources).collect()}
    assert patched == {1: "http://h/b?wr_id=1", 5: "http://h/b?t=n&mode=v&num=5", 6: "http://h/bp".replace("bp", "b?t=n&mode=v&num=6")}
    new, counts = backfill.backfill_content(state, sources, now())
    assert counts.first().asDict() == {"matched": 5, "skipped": 0} and new.first().backfilledAt is not None
    merged = backfill.replace_rows(state, new)
    assert merged.count() == 6 and backfill.replace_attachments(state, backfill.backfill_referer(state, sources)).where("get(attachments, 0).referer like 'http%'").count() == 3
    assert backfill.gate(backfill.content_candidates(state), False) == (5, False)


def test_summaries(spark):
    t = lambda d: datetime.datetime(2026, 4, d)
    state = notices(
        spark, base(1, contentText="One. Two", crawledAt=t(1)), base(2, contentText="", crawledAt=t(2)), base(3, contentText="x", summaryFailures=3), base(4, contentText="y", crawledAt=t(3)),
        base(5, contentText="z", summaryAt=t(1), summaryContentHash="other"), base(6, contentText="z", summaryAt=t(1), summaryContentHash="h6"))
    assert [r.articleNo for r in enrich.pending(state).collect()] == [4, 1] and [r.articleNo for r in enrich.pending(state, 1).collect()] == [4]
    assert [r.articleNo for r in enrich.stale(state).collect()] == [5]
    after = {r.articleNo: r for r in flows.summaries(state, now()).collect()}
    assert after[1].summaryOneLiner == "One" and after[1].summaryContentHash == "h1" and after[1].summaryFailures == 0 and after[5].summaryContentHash == "h5" and after[3].summary is None

    def broken():
        def call(*_):
            raise RuntimeError

        return call

    failed = enrich.summarise(enrich.pending(state), broken)
    assert enrich.summary_counters(failed).first().asDict() == {"succeeded": 0, "failed": 2}
    assert enrich.write_summaries(state, failed, now()).where("articleNo = 1").first().summaryFailures == 1
    assert merge.unset_fields(state).where("summaryAt is not null").count() == 0


def test_catalogue(spark, tmp_path):
    good = {"id": "a-b", "name": "A", "strategy": "pyxis-api", "campus": "nsc", "college": "C", "appCategory": "lib", "crawlAvailable": True, "crawlEnabled": True, "excludeReason": None}
    bad = {"id": "a-b", "strategy": "nope", "campus": "moon", "appCategory": "zz", "crawlAvailable": False, "crawlEnabled": True, "excludeReason": None}
    off = good | {"id": "o", "name": "O", "crawlAvailable": False, "crawlEnabled": False, "excludeReason": "noWebsite", "strategy": "gnuboard"}
    import json

    (tmp_path / "s.json").write_text(json.dumps([good, bad, off]))
    (tmp_path / "good.json").write_text(json.dumps([good]))
    cats = [
        {"id": "lib", "label": {"ko": "k", "en": "e"}, "tabMode": "picker", "maxSelection": 1, "defaultIds": ["a-b", "x"], "campusDefaultIds": {"nsc": ["o"], "mars": []}},
        {"id": "fix", "label": {"ko": "k"}, "tabMode": "fixed", "fixedSourceId": "o"}, {"id": "fix", "label": {"ko": "k", "en": "e"}, "tabMode": "odd"}]
    (tmp_path / "c.json").write_text(json.dumps(cats))
    sources, categories = catalog.read_sources(spark, str(tmp_path / "s.json")), catalog.read_categories(spark, str(tmp_path / "c.json"))
    rules = lambda df: sorted({r.rule for r in df.collect()})
    assert rules(catalog.selector_errors(sources)) == ["duplicate_id", "missing_selectors", "unknown_strategy"]
    assert rules(catalog.source_errors(sources, categories)) == ["duplicate_id", "invalid_campus", "invalid_category", "missing_field", "unavailable_enabled", "unavailable_without_reason", "unknown_strategy"]
    assert rules(catalog.category_errors(categories, sources)) == ["campus_default_not_enabled", "category_without_entry", "default_not_enabled", "duplicate_id", "invalid_campus_key", "invalid_tab_mode", "missing_label", "seed_above_max", "unavailable_fixed_source"]
    with pytest.raises(ValueError, match="unknown strategy nope"):
        catalog.load_and_validate(spark, str(tmp_path / "s.json"))
    one = catalog.load_and_validate(spark, str(tmp_path / "good.json"))
    assert catalog.source_enum(one).first().text == 'A_B = "a-b"' and catalog.filter_line(sources).first().text == "CRAWL_SOURCE_FILTER=a-b"
    assert json.loads(catalog.server_sources(one).first().text) == {k: good[k] for k in ("id", "name", "campus", "college", "appCategory", "crawlAvailable", "excludeReason")} | {"hasCategory": True, "hasAuthor": False}
    served = [json.loads(r.text) for r in catalog.server_categories(categories, sources).collect()]
    assert served[0]["sourceIds"] == ["a-b", "o"] and served[1]["sourceId"] == "o"
    assert catalog.coverage(sources).first().asDict() == {"total": 3, "enabled": 1, "strategies": 3}
    assert [r.strategy for r in catalog.strategy_histogram(sources).collect()] == ["pyxis-api", "nope", "gnuboard"]
    assert [r.appCategory for r in catalog.by_category(sources, categories).collect()] == ["lib", "zz"]
    table = catalog.markdown_table(catalog.grouped(sources, "campus"), [F.asc_nulls_last("campus")])
    catalog.write_text(table, str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert lines[0] == "| campus | n | names |" and lines[2].startswith("| moon | 1 |")
    assert catalog.grouped(sources, "campus", "college").count() == 2


def test_config():
    assert load_config({}).database == "notices_dev" and load_config({"APP_ENV": "production", "DB_NAME": "d"}).database == "d" and load_config({"APP_ENV": "test"}).database == "notices_test"
    assert load_config({"CRAWL_SOURCE_FILTER": "a, b,"}).source_filter == ("a", "b") and load_config({"CRAWL_SOURCE_FILTER": " "}).source_filter is None


def test_crawl_and_update_check_end_to_end(spark):
    src = {
        "id": "s", "name": "Dept", "strategy": "gnuboard", "crawlAvailable": True, "crawlEnabled": True, "baseUrl": "http://h/b", "boardParam": "t", "boardName": "n", "skinType": "table",
        "selectors": {"listRow": "tr", "titleLink": "a", "author": "i", "date": "b", "detailContent": "#c", "detailAttachment": "a.f"}}
    sources = spark.createDataFrame([tuple(src.get(f.name) for f in SOURCE)], SOURCE)
    row = lambda no, title, date="2026-04-01": f'<tr><td><a href="?t=n&wr_id={no}">{title}</a></td><td><i>W</i><b>{date}</b></td></tr>'
    detail = lambda text: f'<div id="c"><p>{text}</p></div><a class="f" href="/f">file</a>'

    def site(pages, details):
        rows = [(f"http://h/b?t=n&page={i + 1}", 200, bytearray(f"<table>{''.join(p)}</table>".encode())) for i, p in enumerate(pages)]
        rows += [(f"http://h/b?t=n&wr_id={k}", 200, bytearray(detail(v).encode())) for k, v in details.items()]
        table = spark.createDataFrame(rows, "url string, status int, body binary")
        return lambda requests: fetch_from_table(requests, table)

    empty = spark.createDataFrame([], NOTICE)
    first = site([[row(2, "two"), row(1, "one")], [row(9, "old", "2020-01-01")]], {1: "first", 2: "second"})
    state, counts = flows.crawl(empty, sources, first, now(), "2026-04-10", pages=4)
    rows = {r.articleNo: r for r in state.collect()}
    assert sorted(rows) == [1, 2] and rows[1].contentText == "first" and rows[1].cleanMarkdown == "first" and rows[1].attachments[0].referer == "http://h/b?t=n&wr_id=1" and rows[1].department == "Dept"
    assert counts.first().asDict() == {"sourceId": "s", "inserted": 2, "updated": 0, "skipped": 0, "errors": 0}
    state = spark.createDataFrame(state.collect(), NOTICE)
    second = site([[row(3, "three"), row(2, "two, edited"), row(1, "one")]], {2: "second, edited"})
    state2, counts = flows.crawl(state, sources, second, now(), "2026-04-10", pages=4)
    rows = {r.articleNo: r for r in state2.collect()}
    assert rows[2].title == "two, edited" and rows[2].editCount == 1 and sorted(rows) == [1, 2]
    # two errors: the page of notice 3 and the second list page, both of which the site lacks
    assert counts.first().asDict() == {"sourceId": "s", "inserted": 0, "updated": 1, "skipped": 1, "errors": 2}
    asked = []
    quiet = site([[row(2, "two"), row(1, "one")]], {})

    def watched(requests):
        asked.extend(r.url for r in requests.collect())
        return quiet(requests)

    _, counts = flows.crawl(state, sources, watched, now(), "2026-04-10")
    assert asked == ["http://h/b?t=n&page=1"] and counts.first().asDict() == {"sourceId": "s", "inserted": 0, "updated": 0, "skipped": 2, "errors": 0}
    checked, c = flows.update_check(state, sources, site([], {1: "first", 2: "changed silently"}), now(), F.lit("2026-04-10").cast("date"))
    rows = {r.articleNo: r for r in checked.collect()}
    assert rows[2].contentText == "changed silently" and rows[2].editCount == 1 and rows[1].editCount == 0 and (c.first().checked, c.first().changed) == (2, 1)
    images = notices(spark, base(1, cleanHtml='<img src="http://a/1"><img src="http://a/2"><img src="/x">'))
    b = flows.broken_images(images, spark.createDataFrame([("http://a/1", 200)], "url string, status int")).first()
    assert (b.checked, b.broken, b.sample) == (2, 1, ["http://a/2"])
    reports = flows.validation(state, sources, ["h"])
    assert reports["attachments"].first().notices == 2
