"""Every command on a small table, with pages from a table in place of the network; and HTTP against a server of our own."""

import datetime as dt
import http.server
import json
import logging
import threading

import pytest
from pyspark.sql import functions as F

from tidings import __main__ as cli
from tidings.operators import merge
from tidings.operators.store import Buckets
from tidings.plans import resume, views
from tidings.plans.flow_queries import BOARD
from tidings.session import Watch
from tidings.sources import fetching
from tidings.sources.fetching import fetch_from_table

SITE = {
    "?t=n&page=1": "<table><tr><td><a class='t' href='?t=n&amp;wr_id=1'>One</a></td><td><i>w</i><b>2026-11-20</b><u>5</u></td></tr></table>", "?t=n&page=2": "<table></table>",
    "?t=n&wr_id=1": "<div id='c'><p>Text</p></div><a class='f' href='/f/1'>a.pdf</a>", "?t=n&wr_id=2": "<div id='c'><p>Other</p></div><a class='f' href='/f/2'>b.pdf</a>",
}


@pytest.fixture
def place(spark, tmp_path, monkeypatch):
    """A table with one old notice, a catalogue, and a site."""
    day = dt.date.today().isoformat()
    store = Buckets(spark, str(tmp_path / "store"), buckets=(4, 2))
    old = spark.createDataFrame([("s0", 2, "Two", day, "<p>Old</p>", "?t=n&wr_id=2", "h"), ("s0", 3, "Three", day, "", "?t=n&wr_id=3", None)], "sourceId string, articleNo long, title string, date string, content string, detailPath string, contentHash string")
    store.merge(views.as_notices(old.withColumns({"crawledAt": F.current_timestamp(), "attachments": F.array()})).withColumn("action", F.lit("new")), merge.merge_notices)
    catalog = tmp_path / "catalog.json"
    catalog.write_text(json.dumps([BOARD | {"id": "s0", "baseUrl": "https://h0.example/b", "campus": "c", "appCategory": "a", "college": "k", "pagination": {"type": "page", "param": "page", "limit": 10}}]))
    pages = spark.createDataFrame([(f"https://h0.example/b{k}", 200, v.encode()) for k, v in SITE.items()], "url string, status int, body binary")
    monkeypatch.setattr(cli, "network", lambda make=None: lambda requests: fetch_from_table(requests, pages))
    monkeypatch.setattr(cli, "ask", lambda question: "no")

    def run(command, *more):
        return cli.run(spark, cli.parser().parse_args([command, "--store", store.path, "--catalog", str(catalog), *more]))

    return run, store


def rows(store):
    return {r.articleNo: r for r in store.read().collect()}


def test_crawl_and_update_check(place, caplog):
    run, store = place
    with caplog.at_level(logging.INFO, "tidings"):
        assert run("crawl") == 0
    assert json.loads(caplog.records[-1].message)["inserted"] == 1
    found = rows(store)
    assert set(found) == {1, 2, 3} and found[1].contentText == "Text" and found[1].attachments[0].url == "https://h0.example/f/1"
    assert run("update-check") == 0
    assert rows(store)[2].contentText == "Other" and rows(store)[2].editCount == 1 and rows(store)[3].consecutiveFailures == 1


def test_a_schedule_runs_in_turn_and_survives_failures(place, spark, monkeypatch):
    run, store = place
    ran, now = [], [0.0]

    def one(spark, args):
        ran.append((args.command, now[0]))
        now[0] += 70
        if len(ran) == 2:
            raise RuntimeError("no network")
        return 0

    args = cli.parser().parse_args(["start", "--store", store.path, "--catalog", "c", "--every", "100", "--runs", "3"])
    with monkeypatch.context() as m:
        m.setattr(cli, "run", one)
        slept = []
        assert cli.scheduled(spark, args, slept.append, lambda: now[0]) == 2
    assert [c for c, _ in ran] == ["crawl", "update-check"] * 3 and slept == []  # turns of 140 seconds leave no pause
    assert run("start", "--runs", "1") == 0 and rows(store)[1].contentText == "Text"


def test_summaries_and_checks(place, capsys):
    run, store = place
    assert run("crawl") == 0 and run("summarize", "--limit", "5") == 0
    assert rows(store)[1].summary == "Text"
    assert run("validate-markdown") == 0
    assert run("validate-attachments", "--no-http", "--hosts", "h0.example") == 0
    assert run("validate-attachments", "--hosts", "h0.example", "--json") == 0 or "url" in capsys.readouterr().out


def test_backfills_count_ask_and_apply(place, capsys, tmp_path, monkeypatch):
    run, store = place
    assert run("backfill-content") == 0 and "nothing written" in capsys.readouterr().out
    assert run("backfill-content", "--apply") == 1 and rows(store)[2].cleanHtml is None
    monkeypatch.setattr(cli, "ask", lambda question: "yes")
    assert run("backfill-content", "--apply", "--progress", str(tmp_path / "p")) == 0
    assert rows(store)[2].cleanHtml == "<p>Old</p>" and "16 units done" in capsys.readouterr().out
    assert run("backfill-content", "--apply", "--progress", str(tmp_path / "p")) == 0 and "0 units done" in capsys.readouterr().out
    assert run("backfill-referer", "--apply", "--yes") == 0
    assert run("backfill-attachments", "--apply", "--yes", "--successes", "1") == 0
    assert run("backfill-downloads", "--apply", "--yes") == 0


def test_queries_are_listed(spark, capsys):
    assert cli.run(spark, cli.parser().parse_args(["query"])) == 0 and "q01_pending_topk" in capsys.readouterr().out
    assert cli.run(spark, cli.parser().parse_args(["query", "no such", "x"])) == 1


def test_a_killed_backfill_goes_on_where_it_stopped(spark, tmp_path):
    notices = spark.range(200).select(F.lit("s").alias("sourceId"), F.col("id").alias("articleNo"))
    done, dies = [], [True]

    def work(part):
        if dies[0] and len(done) == 3:
            raise RuntimeError("killed")
        done.append(part.count())
        return part.withColumn("n", F.col("articleNo") * 2)

    units = resume.Units(spark, str(tmp_path / "p"), 8)
    with pytest.raises(RuntimeError):
        units.run(notices, work)
    assert len(done) == 3 and units.results().count() == sum(done)
    dies[0] = False
    again = resume.Units(spark, str(tmp_path / "p"), 99)
    assert again.n == 8 and again.run(notices, work) == 5 and again.left() == []
    assert sum(done) == 200 == again.results().count() == again.results().distinct().count()


def test_counts_are_taken_while_rows_are_written(spark, tmp_path):
    for n in (7, 0):
        watch = Watch(all=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
        watch(spark.range(n)).write.parquet(str(tmp_path / str(n)))
        assert watch.counts() == {"all": n, "even": (n + 1) // 2}


class Site(http.server.BaseHTTPRequestHandler):
    tries = 0

    def do_GET(self):
        if self.path == "/busy":
            Site.tries += 1
        status = {"/ok": 200, "/part": 206, "/busy": 503 if Site.tries < 3 else 200}.get(self.path, 404)
        self.send_response(status)
        self.end_headers()
        self.wfile.write((self.headers.get("User-Agent", "")[:11] + self.path).encode())

    def do_HEAD(self):
        self.send_response(200 if self.path == "/ok" else 404)
        self.end_headers()

    def log_message(self, *args):
        pass


def test_http_against_a_server(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        get = fetching.Http(most=14)
        assert get(f"{base}/ok") == fetching.Answer(200, b"Mozilla/5.0/ok") and get(f"{base}/part").status == 200 and get(f"{base}/gone") == fetching.Answer(404)
        assert get(f"{base}/ok-and-longer-than-that").status == 404 and fetching.Http("HEAD")(f"{base}/ok") == fetching.Answer(200) and fetching.Http("HEAD")(f"{base}/x").status == 404
        assert get("http://127.0.0.1:1/") == fetching.Answer(0) and get("nonsense") == fetching.Answer(0)
        waits = []
        again = fetching.Retrying(fetching.Http(), gap=0.0, sleep=waits.append)
        assert again(f"{base}/busy").status == 200 and Site.tries == 3 and waits == [1.0, 2.0]
        asked = spark.createDataFrame([(f"{base}/ok",), (f"{base}/gone",), (None,)], "url string")
        got = {r.url: r.status for r in fetching.fetch(asked, lambda: fetching.Http()).collect()}
        assert got == {f"{base}/ok": 200, f"{base}/gone": 404, None: 0}
    finally:
        server.shutdown()
