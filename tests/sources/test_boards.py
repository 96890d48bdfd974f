import json

from pyspark.sql import functions as F

from tidings.schemas import SOURCE
from tidings.sources import readers
from tidings.sources.boards import BOARDS, linked_files, normalize_date, without_word_processor_data
from tidings.sources.datasource import BoardDataSource
from tidings.sources.fetching import Answer, Once, Retrying, TimedOut, fetch, fetch_from_table, fetch_rounds

STANDARD = {
    "id": "s", "strategy": "standard", "baseUrl": "http://h/board.do", "pagination": {"limit": 10, "param": "offset"},
    "selectors": {"listItem": "dl.n", "category": "span.c", "titleLink": "dt a", "infoList": "dd li", "detailContent": "div.v", "attachmentList": "ul.f a"},
}
LIST = """<dl class="n"><dt><span class="c">[News]</span><a href="?mode=view&articleNo=12">Title</a></dt><dd><ul><li>no</li><li>Kim</li><li>2026-04-01</li><li>hits 33</li></ul></dd></dl>
<dl class="n"><dt><a href="?x=1">no number</a></dt></dl>"""


def transport(url):
    return Answer(200, LIST.encode()) if "mode=list" in url else Answer(404)


def test_standard_list_and_detail():
    b = BOARDS["standard"]
    assert b.list_url(STANDARD, 2) == "http://h/board.do?mode=list&articleLimit=10&offset=20"
    assert b.items(LIST, STANDARD, 0, "2026-04-15") == [{"articleNo": 12, "title": "Title", "category": "News", "author": "Kim", "date": "2026-04-01", "views": 33, "detailPath": "?mode=view&articleNo=12"}]
    page = '<div class="fr-view"><p>x</p></div><ul class="f"><a href="#">n</a><a href="?d=1">a</a><a href="f/b.pdf">b</a><a href="http://x/c">c</a></ul>'
    d = b.detail(page, STANDARD, "?a=1", 12)
    assert d["content"] == "<p>x</p>" and [x["url"] for x in d["attachments"]] == ["http://h/board.do?d=1", "http://h/f/b.pdf", "http://x/c"]
    click = STANDARD | {"attachmentParser": "onclick"}
    found = b.detail("""<ul class="f"><a onclick="location.href='/d?x=1&amp;y=2'">n</a></ul>""", click, "", 1)
    assert found["attachments"] == [{"name": "n", "url": "http://h/d?x=1&y=2"}]
    extra = STANDARD | {"extraParams": {"k": "9"}}
    assert b.detail_url(extra, "?a=1", 1) == "http://h/board.do?a=1&k=9" and b.detail_url(STANDARD, "", 5).endswith("?mode=view&articleNo=5&article.offset=0&articleLimit=10")


def test_labelled_facts():
    c = STANDARD | {"infoParser": "labeled", "selectors": STANDARD["selectors"] | {"category": ""}}
    html = '<dl class="n"><dt><a href="v?itemId=7">T</a></dt><dd><li>Posted Date : 2026-01-02</li><li>Writer : Lee</li><li>Hit : 5</li></dd></dl>'
    x = BOARDS["standard"].items(html, c, 0, "2026-04-15")[0]
    assert (x["articleNo"], x["date"], x["author"], x["views"], x["category"]) == (7, "2026-01-02", "Lee", 5, "")


def test_gnuboard_skins():
    s = {"listRow": "tr", "titleLink": "a", "author": "td.w", "date": "td.d", "views": "td.v", "detailContent": "#c", "detailAttachment": "a.f"}
    c = {"strategy": "gnuboard", "baseUrl": "https://h/b.php", "boardParam": "t", "boardName": "n", "skinType": "table", "selectors": s}
    html = '<table><tr><td><a href="?wr_id=4">T</a></td><td class="w">W</td><td class="d">05-01</td><td class="v">7</td></tr><tr><td>x</td></tr></table>'
    assert BOARDS["gnuboard"].items(html, c, 0, "2026-04-15") == [{"articleNo": 4, "title": "T", "category": "", "author": "W", "date": "2025-05-01", "views": 7, "detailPath": "?wr_id=4"}]
    c2 = c | {"skinType": "list", "selectors": s | {"listRow": "li", "titleText": "h2", "author": "i", "date": "b"}}
    x = BOARDS["gnuboard"].items('<li><a href="//h/b?wr_id=9"><h2><span class="category">K</span> Name</h2></a><b>26-03-10</b></li>', c2, 0, "2026-04-15")[0]
    assert x["title"] == "Name" and x["detailPath"] == "https://h/b?wr_id=9" and x["date"] == "2026-03-10"
    d = BOARDS["gnuboard"].detail('<div id="c">x</div><a class="f" href="/f/1">n</a><a class="f" href="g">m</a>', c, "?wr_id=4", 4)
    assert d["attachments"] == [{"name": "n", "url": "https://h/f/1", "referer": "https://h/b.php?wr_id=4"}, {"name": "m", "url": "https://h/g", "referer": "https://h/b.php?wr_id=4"}]
    assert normalize_date("04-30", "2026-04-15") == "2026-04-30" and normalize_date("", "2026-04-15") == ""


def test_other_boards():
    custom = {"baseUrl": "https://h/b", "boardParam": "t", "boardName": "n", "detailMode": "v", "selectors": {"listRow": "tr", "titleLink": "a", "date": "em", "meta": "i", "detailContent": "#c", "detailAttachment": "a.f"}}
    row = '<table><tr><td><img src="/btn_notice.gif"><a href="?num=3">T</a></td><td><i>Park | 조회수 : 12</i><em>2026-01-01</em></td></tr></table>'
    b = BOARDS["gnuboard-custom"]
    assert b.items(row, custom, 0, "2026-04-15")[0] | {} == {"articleNo": 3, "title": "T", "category": "", "author": "Park", "date": "2026-01-01", "views": 12, "detailPath": "?num=3"}
    assert b.items(row, custom, 1, "2026-04-15") == [] and b.detail_url(custom, "", 3) == "https://h/b?t=n&mode=v&num=3"
    assert without_word_processor_data('a<!--[data-hwpjson]{x}[data-hwpjson]--><p data-hwpjson="y">b</p>') == "a<p>b</p>"
    php = {"baseUrl": "https://h/d/i.php", "boardParams": {"bo": "한"}, "selectors": {"listRow": "tr", "titleLink": "a", "category": "td.c", "views": "td.v", "date": "td.d", "detailContent": "#c", "detailTitle": "h1"}}
    b = BOARDS["custom-php"]
    assert b.list_url(php, 0) == "https://h/d/i.php?bo=%ED%95%9C&pg=1&page=list"
    d = b.detail('<h1> T </h1><div id="c">x</div><div class="attachment"><a href="./f.php?name=a%20b.pdf">l</a><a href="./f.php?name=a%20b.pdf">l</a><a href="#">z</a><a href="/q/r.pdf"></a></div>', php, "", 1)
    assert d["title"] == "T" and d["attachments"] == [{"name": "a b.pdf", "url": "https://h/d/f.php?name=a%20b.pdf"}, {"name": "r.pdf", "url": "https://h/q/r.pdf"}]
    jsp = {"baseUrl": "https://h/j", "boardNo": 2, "pagination": {"limit": 10, "param": "o"}, "selectors": {"listRow": "tr", "pinnedRow": "tr", "titleLink": "a", "detailContent": "#c", "attachmentLink": "a.f"}}
    row = '<table><tr style="background: #f4f4f4"><td>1</td><td>K</td><td><a href="?article_no=8">T</a></td><td></td><td>2026-01-01</td><td>5</td></tr></table>'
    assert BOARDS["jsp-dorm"].items(row, jsp, 0, "")[0]["articleNo"] == 8 and BOARDS["jsp-dorm"].items(row, jsp, 1, "") == []
    assert BOARDS["jsp-dorm"].detail('<a class="f" href="d/x"><img alt="i">N</a>', jsp, "", 1)["attachments"] == [{"name": "N", "url": "https://h/d/x"}]
    asp = STANDARD | {"baseUrl": "http://h/x/l.asp", "pagination": {"param": "pg", "limit": 20}, "extraParams": {"bcode": "1"}}
    b = BOARDS["asp-board"]
    assert b.list_url(asp, 1) == "http://h/x/l.asp?bcode=1&pg=2" and b.detail_url(asp, "v.asp?number=2", 2) == "http://h/v.asp?number=2"
    assert b.items('<dl class="n"><dt><a href="v.asp?number=2">· T</a></dt></dl>', asp, 0, "")[0]["title"] == "T"
    assert b.detail('<div class="v"><title>t</title><p>x</p></div>', asp, "v", 2)["content"] == "<p>x</p>"


def test_json_boards():
    wp = {"baseUrl": "https://w", "pagination": {"limit": 5}}
    post = {"id": 3, "title": {"rendered": "A &amp; B"}, "date": "2026-02-03T01:02", "link": "https://w/3", "content": {"rendered": '<p>x</p><a href="/u/a.pdf">f</a>'}}
    x = BOARDS["wordpress-api"].items(json.dumps([post]), wp, 0, "")[0]
    assert x["title"] == "A & B" and x["date"] == "2026-02-03" and x["detail"]["attachments"] == [{"name": "f", "url": "https://w/u/a.pdf"}]
    assert BOARDS["wordpress-api"].items('{"code": 1}', wp, 9, "") == []
    html = '<a href="https://docs.example.com/form">no</a><a href="/wp-content/uploads/z">u</a><div class="w3eden"><h3 class="package-title"><a href="/download/p">P</a></h3><a data-downloadurl="https://w/download/p?wpdmdl=4&refresh=77">get</a></div>'
    assert linked_files(html, "https://w") == [{"name": "u", "url": "https://w/wp-content/uploads/z"}, {"name": "P", "url": "https://w/download/p?wpdmdl=4"}]
    px = {"baseUrl": "https://l/api", "pagination": {"limit": 2}, "attachmentBase": "https://l/f", "imageBase": "https://l/api", "frontendBase": "https://l/n"}
    body = {"success": True, "data": {"totalCount": 3, "list": [{"id": 1, "title": "T", "dateCreated": "2026-01-02 10:00", "hitCnt": 4, "attachments": [{"physicalName": "p", "logicalName": "L"}, {"originalImageUrl": "/i"}, {}]}]}}
    x = BOARDS["pyxis-api"].items(json.dumps(body), px, 0, "")[0]
    assert x["date"] == "2026-01-02" and x["category"] == "" and x["attachments"] == [{"name": "L", "url": "https://l/f/p"}, {"name": "unknown", "url": "https://l/api/i"}]
    assert BOARDS["pyxis-api"].items(json.dumps(body), px, 2, "") == [] and BOARDS["pyxis-api"].items('{"success": false}', px, 0, "") == []


def test_retrying_transport():
    asked, waits = [], []
    answers = iter([TimedOut(), Answer(503), Answer(200, b"x")])

    def flaky(url):
        asked.append(url)
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    assert Retrying(flaky, gap=0, sleep=waits.append)("u").body == b"x" and len(asked) == 3 and waits == [1.0, 2.0]
    assert Retrying(lambda u: Answer(404), gap=0, sleep=waits.append)("u").status == 404 and len(waits) == 2


def test_reading_in_spark(spark):
    spark.dataSource.register(BoardDataSource)
    rows = spark.read.format("board").option("config", json.dumps(STANDARD)).option("pages", "2").option("transport", "tests.sources.test_boards.transport").load()
    assert sorted((r.page, r.articleNo) for r in rows.collect()) == [(0, 12), (1, 12)]
    sources = spark.createDataFrame([tuple(STANDARD.get(f.name) if f.name != "pagination" else (None, "offset", 10) for f in SOURCE)], SOURCE)
    plan = readers.page_plan(sources, 1)
    fetched = fetch_from_table(plan, plan.select("url", F.lit(200).alias("status"), F.lit(LIST).cast("binary").alias("body")))
    items = readers.read_lists(fetched, sources, "2026-04-15")
    assert [(r.sourceId, r.articleNo, r.author) for r in items.collect()] == [("s", 12, "Kim")]
    refs = readers.detail_plan(items.select("sourceId", "articleNo", "detailPath"), sources)
    assert refs.first()["url"] == "http://h/board.do?mode=view&articleNo=12"
    missing = readers.read_details(fetch_from_table(refs, spark.createDataFrame([], "url string, status int, body binary")), sources)
    assert missing.first()["status"] == 404 and missing.first()["detail"] is None
    live = fetch(plan, lambda: transport)
    assert [r.status for r in live.collect()] == [200]
    korean = spark.createDataFrame([(bytearray("공지".encode("cp949")),), (None,)], "b binary")
    assert [r.t for r in korean.select(readers.decode_korean("b").alias("t")).collect()] == ["공지", None]
    png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + (640).to_bytes(4) + (480).to_bytes(4)
    assert readers.image_size(png) == (640, 480) and readers.image_size(b"junk") is None
    sized = spark.createDataFrame([(bytearray(png),), (None,)], "b binary").select(readers.image_size_udf("b").alias("s")).collect()
    assert (sized[0].s.w, sized[0].s.h, sized[1].s.w) == (640, 480, None)


NOW = [1000.0]


def now():
    return NOW[0]


def test_polls_as_a_stream(spark, tmp_path):
    """A poll is made once, by a task a host; the next start goes on with the next one."""
    spark.dataSource.register(BoardDataSource)
    configs = [STANDARD | {"id": f"s{k}", "baseUrl": f"http://h{k % 2}/board.do"} for k in range(3)]
    options = {"config": json.dumps(configs), "pages": "2", "transport": "tests.sources.test_boards.transport", "every": "100", "clock": "tests.sources.test_boards.now"}
    reader = BoardDataSource(options).streamReader(None)
    parts = reader.partitions({"poll": 9}, {"poll": 10})
    assert sorted(sorted((c["id"], p) for c, p in x.pages) for x in parts) == [[("s0", 0), ("s0", 1), ("s2", 0), ("s2", 1)], [("s1", 0), ("s1", 1)]]
    assert reader.partitions({"poll": 10}, {"poll": 10}) == []
    few = BoardDataSource(options | {"hosts": "1"}).streamReader(None)
    assert {few.partitions({"poll": k - 1}, {"poll": k})[0].pages[0][0]["baseUrl"] for k in (10, 11)} == {"http://h0/board.do", "http://h1/board.do"}
    assert NOW == [1000.0] and reader.latestOffset() == {"poll": 10} and reader.initialOffset() == {"poll": 9}
    got = []

    def start():
        stream = spark.readStream.format("board").options(**{k: v for k, v in options.items() if k != "clock"}).option("every", "1000000000").load()
        query = stream.writeStream.foreachBatch(lambda df, n: got.extend((r.sourceId, r.page, r.poll) for r in df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(90)

    start()
    assert sorted((s, p) for s, p, _ in got) == [(f"s{k}", p) for k in range(3) for p in range(2)]
    start()  # the same poll is not read twice
    assert len(got) == 6


def test_pages_that_cannot_be_read_leave_the_source_standing(spark):
    spark.dataSource.register(BoardDataSource)
    rows = spark.read.format("board").option("config", json.dumps([STANDARD, {"id": "w", "strategy": "wordpress-api", "baseUrl": "http://h", "pagination": {"limit": 5}}])).option("transport", "tests.sources.test_boards.broken").load()
    assert rows.count() == 0


def test_a_dead_host_delays_no_other(spark, tmp_path):
    """Of a host that never answers each task asks a few pages a round; nobody sleeps but the driver, and live hosts are asked once."""
    log = str(tmp_path / "asked")

    def transport(url):
        with open(log, "a") as f:
            f.write(url + "\n")
        if url.startswith("http://dead"):
            raise TimedOut
        return Answer(503 if url.endswith("busy") else 200)

    def no_sleep(seconds):
        raise AssertionError("a task slept")

    waits, now = [], [0.0]

    def wait(seconds):
        waits.append(seconds)
        now[0] += seconds

    urls = [f"http://dead/{k}" for k in range(200)] + [f"http://h{k}/x" for k in range(20)] + ["http://h/busy", None]
    asked = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: (r.status, r.tries) for r in fetch_rounds(asked, lambda: Once(transport, gap=0.0, sleep=no_sleep), clock=lambda: now[0], wait=wait).collect()}
    assert len(got) == 222 and got["http://h3/x"] == (200, 1) and got["http://h/busy"] == (503, 3) and got["http://dead/7"] == (0, 3) and got[None] == (0, 1)
    lines = open(log).read().split()
    assert sum(u.startswith("http://dead") for u in lines) == 3 * 3 and lines.count("http://h/busy") == 3 and lines.count("http://h3/x") == 1
    assert waits == [1.0, 2.0]


def test_gaps_hold_by_host():
    now, waits = [0.0], []

    def sleep(seconds):
        waits.append(seconds)
        now[0] += seconds

    ask = Once(lambda url: Answer(200), gap=0.5, sleep=sleep, clock=lambda: now[0])
    for u in ("http://a/1", "http://b/1", "http://a/2", "http://a/3", "http://b/2"):
        ask(u)
    assert waits == [0.5, 0.5]


def broken(url):
    return Answer(200, b"[{\xff\xfe]")
