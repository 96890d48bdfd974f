"""Queries over pages built from the driver's tables: boards of every kind, and the page transforms case by case.

Each board query writes the rows of `orders` or `customer` as pages of one kind of board, reads these with the board's
reader, and must give the rows back. Each transform query applies a list of cases, one by each customer's key, with the
customer's name in it; the SQL states what must come out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions import textify, urls
from tidings.functions.clean import clean_html, normalize_content_urls
from tidings.plans.queries import query
from tidings.plans.views import table
from tidings.schemas import SOURCE
from tidings.sources import readers

AS_OF = "2026-04-15"
BASE = "https://h.example/b/list.do"


def _source(spark, n: int, config: dict) -> DataFrame:
    """`n` sources `s0`, `s1`, ... of one configuration."""
    row = tuple(config.get(f.name) for f in SOURCE)
    one = spark.createDataFrame([row], SOURCE)
    return one.withColumn("id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.concat(F.lit("s"), k.cast("string")))))


def _text(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def number() -> Column:
    return F.col("o_orderkey").cast("string")


def status() -> Column:
    return F.col("o_orderstatus")


def priority() -> Column:
    return F.col("o_orderpriority")


def day() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd")


def views_() -> Column:
    return (F.col("o_orderkey") % 1000).cast("string")


def title_() -> Column:
    return _text("Order ", number(), " &amp; &lt;more&gt;")


DATED = "strftime(o_orderdate, '%Y-%m-%d')"
MONTH_DAY = "(2026 - CASE WHEN month(o_orderdate) > 4 THEN 1 ELSE 0 END)::VARCHAR || '-' || strftime(o_orderdate, '%m-%d')"
SELECT = """SELECT 's' || (o_custkey % 25) AS source, o_orderkey AS no, {title} AS title, {category} AS category, {author} AS author, {date} AS date, {views} AS views, {path} AS path FROM orders WHERE {where}"""
PLAIN = {
    "title": "'Order ' || o_orderkey || ' & <more>'", "category": "''", "author": "o_orderpriority", "date": DATED, "views": "o_orderkey % 1000", "where": "true",
}


def _listed(name: str, config: dict, row: Callable[[], Column], expected: dict, *, wrap: tuple[str, str] = ("<div>", "</div>"), encoding: str = "UTF-8", json: bool = False) -> None:
    """Register a query that reads list pages, one for each customer, on page 0 or 1."""

    @query(name, SELECT.format(**(PLAIN | expected)))
    def run(spark, d):
        rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), row().alias("r")))), lambda x: x["r"])
        body = F.concat(F.lit(wrap[0]), F.array_join(rows, "," if json else ""), F.lit(wrap[1]))
        pages = table(spark, d, "orders").groupBy("o_custkey").agg(body.alias("body"))
        fetched = pages.select(
            F.concat(F.lit("s"), (F.col("o_custkey") % 25).cast("string")).alias("sourceId"), (F.col("o_custkey") % 2).cast("int").alias("page"), F.lit(200).alias("status"),
            F.encode("body", encoding).alias("body"))
        found = readers.read_lists(fetched, _source(spark, 25, {"baseUrl": BASE, "boardParam": "t", "boardName": "n"} | config), AS_OF)
        return found.select(F.col("sourceId").alias("source"), F.col("articleNo").alias("no"), "title", "category", "author", "date", "views", F.col("detailPath").alias("path"))


LINK = lambda href: _text('<a class="t" href="', href, '">', title_(), "</a>")
FACTS = {"listItem": "li", "listRow": "tr", "titleLink": "a.t", "infoList": "i", "category": "u", "author": ".w", "date": ".d", "views": ".v", "meta": ".m", "titleText": "h3"}
STANDARD_PATH = "'?mode=view&articleNo=' || o_orderkey"
_listed("q50_board_standard", {"strategy": "standard", "selectors": FACTS, "pagination": ("offset", "article.offset", 10)}, lambda: _text(
    "<li><u>[", status(), "]</u>", LINK(_text("?mode=view&amp;articleNo=", number())), "<i>x</i><i>", priority(), "</i><i>", day(), "</i><i>hits ", views_(), "</i></li>"),
    {"category": "o_orderstatus", "path": STANDARD_PATH})
_listed("q50b_board_labelled", {"strategy": "standard", "selectors": FACTS, "infoParser": "labeled", "pagination": ("offset", "article.offset", 10)}, lambda: _text(
    "<li>", LINK(_text("?mode=view&amp;articleNo=", number())), "<i>Hit : ", views_(), "</i><i>Writer : ", priority(), "</i><i>Posted Date : ", day(), "</i></li><li><a class='t' href='#'>no number</a></li>"),
    {"path": STANDARD_PATH})
# ISO-8859-1 writes these characters as the bytes that the old Korean encoding has for a middle dot and a syllable.
_listed("q50c_board_asp", {"strategy": "asp-board", "selectors": FACTS, "pagination": ("page", "page", 10)}, lambda: _text(
    "<li><a class='t' href='view.asp?number=", number(), "'>¡¤ °¡ Order ", number(), "</a><i>x</i><i>", priority(), "</i><i>", day(), "</i><i>", views_(), "</i></li>"),
    {"title": "'가 Order ' || o_orderkey", "path": "'view.asp?number=' || o_orderkey"}, encoding="ISO-8859-1")
_listed("q50d_board_gnuboard_table", {"strategy": "gnuboard", "skinType": "table", "selectors": FACTS}, lambda: _text(
    "<tr><td>", LINK(_text("https://h.example/b?t=n&amp;wr_id=", number())), "</td><td class='w'>", priority(), "</td><td class='d'>", F.date_format("o_orderdate", "MM-dd"), "</td><td class='v'>", views_(), "</td></tr><tr><td>one</td></tr>"),
    {"date": MONTH_DAY, "path": "'https://h.example/b?t=n&wr_id=' || o_orderkey"}, wrap=("<table>", "</table>"))
_listed("q50e_board_gnuboard_list", {"strategy": "gnuboard", "skinType": "list", "selectors": FACTS | {"listRow": "li"}}, lambda: _text(
    "<li><h3><span class='category'>", status(), "@</span> ", title_(), "</h3>", LINK(_text("//h.example/b?wr_id=", number())), "<b class='w'>", priority(), "</b><b class='d'>", F.date_format("o_orderdate", "yy-MM-dd"), "</b><b class='v'>", views_(), "</b></li>"),
    {"date": "'20' || strftime(o_orderdate, '%y-%m-%d')", "path": "'https://h.example/b?wr_id=' || o_orderkey"})
_listed("q50f_board_gnuboard_custom", {"strategy": "gnuboard-custom", "detailMode": "v", "selectors": FACTS}, lambda: _text(
    "<tr><td>", F.when(F.col("o_orderkey") % 3 == 0, '<img src="/img/btn_notice.gif">').otherwise(""), LINK(_text("?num=", number())), "</td><td class='m'>", priority(), " | 조회수 : ", views_(), "</td><td class='d'>", day(), "</td></tr>"),
    {"path": "'?num=' || o_orderkey", "where": "NOT (o_custkey % 2 = 1 AND o_orderkey % 3 = 0)"}, wrap=("<table>", "</table>"))
_listed("q50g_board_custom_php", {"strategy": "custom-php", "boardParams": {"a": "b"}, "selectors": FACTS}, lambda: _text(
    "<tr><td><u>", status(), "</u></td><td>", LINK(_text("./?idx=", number())), "</td><td class='v'>", views_(), "</td><td class='d'>", day(), "</td></tr><tr><td></td><td><a class='t' href='?idx=1'></a></td></tr>"),
    {"category": "o_orderstatus", "author": "''", "path": "'./?idx=' || o_orderkey"}, wrap=("<table>", "</table>"))
_listed("q50h_board_jsp_dorm", {"strategy": "jsp-dorm", "boardNo": "1", "pagination": ("offset", "o", 10), "selectors": FACTS}, lambda: _text(
    F.when(F.col("o_orderkey") % 3 == 0, '<tr style="background: #f4f4f4">').otherwise("<tr>"), "<td>1</td><td>", status(), "</td><td>", LINK(_text("?article_no=", number())), "</td><td></td><td>", day(), "</td><td>", views_(), "</td></tr>"),
    {"category": "o_orderstatus", "author": "''", "path": "'?article_no=' || o_orderkey", "where": "NOT (o_custkey % 2 = 1 AND o_orderkey % 3 = 0)"}, wrap=("<table>", "</table>"))
_listed("q50i_board_wordpress", {"strategy": "wordpress-api", "pagination": ("page", "page", 10)}, lambda: F.to_json(F.struct(
    F.col("o_orderkey").alias("id"), F.struct(_text("Order ", number(), " &amp; &lt;more&gt;").alias("rendered")).alias("title"), _text(day(), "T10:00:00").alias("date"), _text("https://h.example/?p=", number()).alias("link"))),
    {"author": "''", "views": "0", "path": "'https://h.example/?p=' || o_orderkey"}, wrap=('[{"title": {}},', "]"), json=True)
_listed("q50j_board_pyxis", {"strategy": "pyxis-api", "pagination": ("offset", "offset", 10), "frontendBase": "https://l.example/n"}, lambda: F.to_json(F.struct(
    F.col("o_orderkey").alias("id"), _text("Order ", number(), " & <more>").alias("title"), F.struct(status().alias("name")).alias("bulletinCategory"), priority().alias("writer"),
    _text(day(), " 09:00:00").alias("dateCreated"), (F.col("o_orderkey") % 1000).alias("hitCnt"))),
    {"category": "o_orderstatus", "path": "'https://l.example/n/' || o_orderkey"}, wrap=('{"success": true, "data": {"totalCount": 999999, "list": [{"title": "no id"},', "]}}"), json=True)

# Details


def key_() -> Column:
    return F.col("c_custkey").cast("string")


def name_() -> Column:
    return F.col("c_name")


PAGE = {"detailContent": "#c", "attachmentList": "a.f", "detailAttachment": "a.f", "attachmentLink": "a.f", "detailTitle": "h1"}
DETAIL = """SELECT c_custkey AS no, {content} AS content, {text} AS text, {files} AS files, {title} AS title FROM customer"""


def _detailed(name: str, config: dict, body: Callable[[], Column], files: str, *, path: Callable[[], Column] | None = None, content: str = "'<p>' || c_name || '</p>'", title: str = "NULL::VARCHAR", text: str = "c_name") -> None:
    """Register a query that reads one detail page for each customer."""

    @query(name, DETAIL.format(content=content, text=text, files=files, title=title))
    def run(spark, d):
        fetched = table(spark, d, "customer").select(
            F.concat(F.lit("s"), (F.col("c_custkey") % 25).cast("string")).alias("sourceId"), F.col("c_custkey").alias("articleNo"), (path() if path else F.lit("p")).alias("detailPath"),
            F.lit(200).alias("status"), F.encode(body(), "UTF-8").alias("body"))
        found = readers.read_details(fetched, _source(spark, 25, {"baseUrl": BASE, "boardParam": "t", "boardName": "n", "selectors": PAGE} | config))
        files_of = F.transform("detail.attachments", lambda a: F.concat_ws("|", a["name"], a["url"], a["referer"]))
        return found.select(F.col("articleNo").alias("no"), "detail.content", F.col("detail.contentText").alias("text"), F.array_join(files_of, ",").alias("files"), "detail.title")



def content_() -> Column:
    return _text('<div id="c"><p>', name_(), "</p></div>")



_detailed("q51_detail_standard", {"strategy": "standard"}, lambda: _text(content_(), '<a class="f" href="/f?id=', key_(), '">a.pdf</a><a class="f" href="#">b</a>'), "'a.pdf|https://h.example/f?id=' || c_custkey")
_detailed("q51b_detail_onclick", {"strategy": "standard", "attachmentParser": "onclick"}, lambda: _text('<div class="fr-view"><p>', name_(), "</p></div>", "<a class=\"f\" onclick=\"location.href='/f?a=1&amp;id=", key_(), "'\">a.pdf</a>"), "'a.pdf|https://h.example/f?a=1&id=' || c_custkey")
_detailed("q51c_detail_asp", {"strategy": "asp-board"}, lambda: _text('<div id="c"><style>x</style><p>', name_(), "</p></div>", '<a class="f" href="up/', key_(), '.zip">a.zip</a>'), "'a.zip|https://h.example/up/' || c_custkey || '.zip'")
_detailed("q51d_detail_gnuboard", {"strategy": "gnuboard"}, lambda: _text(content_(), '<a class="f" href="//h.example/f/', key_(), '">a.pdf</a><a class="f" href="?bf=1">b.pdf</a>'),
    f"'a.pdf|https://h.example/f/' || c_custkey || '|{BASE}?wr_id=' || c_custkey || ',b.pdf|https://h.example/?bf=1|{BASE}?wr_id=' || c_custkey", path=lambda: _text("?wr_id=", key_()))
_detailed("q51e_detail_gnuboard_custom", {"strategy": "gnuboard-custom", "detailMode": "v"}, lambda: _text('<div id="c"><!--[data-hwpjson]{"a":1}[data-hwpjson]--><p data-hwpjson="zz">', name_(), "</p></div>", '<a class="f" href="/f">a.pdf</a>'),
    f"'a.pdf|https://h.example/f|{BASE}?t=n&mode=v&num=' || c_custkey")
_detailed("q51f_detail_custom_php", {"strategy": "custom-php", "boardParams": {"a": "b"}}, lambda: _text("<h1>Title ", key_(), "</h1>", content_(), '<a class="f" href="./down.php?name=a+b.pdf&amp;k=', key_(), '">x</a><a class="f" href="./down.php?name=a+b.pdf&amp;k=', key_(), '">again</a>'),
    "'a b.pdf|https://h.example/b/down.php?name=a+b.pdf&k=' || c_custkey", title="'Title ' || c_custkey")
_detailed("q51g_detail_jsp_dorm", {"strategy": "jsp-dorm", "boardNo": "1"}, lambda: _text(content_(), '<a class="f" href="f/', key_(), '">a.pdf</a><a class="f" href="/g"><img src="x"></a>'), "'a.pdf|https://h.example/f/' || c_custkey")
_detailed("q51h_detail_wordpress", {"strategy": "wordpress-api", "baseUrl": "https://h.example"}, lambda: F.to_json(F.struct(F.struct(_text(
    "<p>", name_(), "</p>", '<a href="/wp-content/uploads/', key_(), '"></a><div class="w3eden"><h3 class="package-title"><a>Pack</a></h3><a data-downloadurl="https://h.example/download/x?wpdmdl=1&amp;refresh=2"></a></div>').alias("rendered")).alias("content"))),
    "c_custkey || '|https://h.example/wp-content/uploads/' || c_custkey || ',Pack|https://h.example/download/x?wpdmdl=1'",
    content="""'<p>' || c_name || '</p><a href="/wp-content/uploads/' || c_custkey || '"></a><div class="w3eden"><h3 class="package-title"><a>Pack</a></h3><a data-downloadurl="https://h.example/download/x?wpdmdl=1&amp;refresh=2"></a></div>'""", text="c_name || 'Pack'")
_detailed("q51i_detail_pyxis", {"strategy": "pyxis-api", "attachmentBase": "https://l.example/a", "imageBase": "https://l.example"}, lambda: F.to_json(F.struct(F.lit(True).alias("success"), F.struct(
    _text("<p>", name_(), "</p>").alias("content"), F.array(F.struct(key_().alias("physicalName"), F.lit("a.pdf").alias("logicalName"), F.lit(None).cast("string").alias("originalImageUrl")),
    F.struct(F.lit(None).cast("string").alias("physicalName"), F.lit("i.png").alias("logicalName"), F.lit("/i.png").alias("originalImageUrl"))).alias("attachments")).alias("data"))),
    "'a.pdf|https://l.example/a/' || c_custkey || ',i.png|https://l.example/i.png'")

# Transforms by cases: @ stands for the customer's name.

CLEAN = [
    ("<script>x</script><p>@</p><iframe></iframe>", "<p>@</p>"),  # dropped subtrees
    ('<p>@<img src="data:image/png;base64,AAAA"></p>', "<p>@</p>"),  # small data images
    ('<table class="__se_tbl_ext"><tr><td><p>@</p></td></tr></table>', "<p>@</p>"),  # layout tables
    ("<pre>@\n\nb\nc</pre>", "<p>@</p><p>b<br>c</p>"),  # preformatted blocks
    ('<p><span style="font-weight:700">@</span> x</p>', "<p><strong>@</strong> x</p>"),  # bold by style, bare spans
    ('<p><span style="font-style: italic">@</span> x</p>', "<p><em>@</em> x</p>"),  # slant by style
    ('<p><em style="text-decoration: underline">@</em></p>', "<p>@</p>"),  # underlined emphasis
    ('<a href="/x?a=1">@</a><img src="i.png">', '<a href="http://h.example/x?a=1">@</a><img src="http://h.example/b/i.png">'),  # absolute addresses
    ('<p onclick="x" class="c" style="color:red;position:fixed">@</p>', '<p style="color:red">@</p>'),  # attributes and styles
    ('<p><blink>@</blink><a href="javascript:alert(1)">x</a></p>', "<p>@<a>x</a></p>"),  # elements and schemes
    ("<p>@</p><p> </p><p><b></b></p><div><span> </span></div>", "<p>@</p>"),  # empty elements
    ("<div><div><div>@</div></div></div>", "<div>@</div>"),  # chains of divs
    ("<p>@<b>:</b></p>", "<p>@:</p>"),  # emphasis of punctuation
    ("<p><b>@</b></p><p><b>x</b></p><p><b>y</b></p>", "<p>@</p><p>x</p><p>y</p>"),  # runs of bold blocks
    ("<p><b>@</b> <b>x</b></p>", "<p><b>@ x</b></p>"),  # neighbours of the same emphasis
    ("<p> </p>", None),  # nothing left
    ('<p><a href="java&#9;script:x">@</a></p>', "<p><a>@</a></p>"),
    ('<div><p>@</p></div><a href="?mode=list">list</a><div class="board-view-nav">n</div>', "<div><p>@</p></div>"),
]
MARKDOWN = [
    ("<p>@</p><p>b</p>", "@\n\nb"), ("<p>@<br>b</p>", "@  \nb"), ("<h2>@</h2>", "## @"),
    ("<p><span>@</span></p>", "@"),  # spans
    ("<p><b>@</b><b>x</b></p>", "**@x**"),  # neighbouring bold
    ("<p><b>@<br>x</b></p>", "**@**  \n**x**"),  # bold over a break
    ("<p>- @</p><p>- y</p>", "- @\n- y"), ("<p>· @</p><p>· y</p>", "- @\n- y"),  # lists by dashes and bullets
    ("<ol><li>@</li><li>y</li></ol>", "- @\n- y"),  # numbered lists
    ("<table><tr><td>@</td></tr><tr><td>y</td></tr></table>", "@\n\ny"),  # one column
    ("<table><tr><td><b>@</b></td><td><b>y</b></td></tr><tr><td>1</td><td>2</td></tr></table>", "| **@** | **y** |\n| --- | --- |\n| 1 | 2 |"),  # bold header row
    ("<table><tr><td>@</td><td>y</td></tr><tr><td>1</td><td>2</td></tr></table>", "| @ | y |\n| --- | --- |\n| 1 | 2 |"),  # first row as header
    ("<table><tr><th>@</th><th>y</th></tr><tr><td><p>1</p></td><td>2|3</td></tr></table>", "| @ | y |\n| --- | --- |\n| 1 | 2\\|3 |"),  # blocks and bars in cells
    ("<ul><li><p>@</p></li></ul>", "- @"),  # blocks in items
    ("<p>@ 1~2</p>", "@ 1～2"), ('<p><a href="http://h/~a">@</a></p>', "[@](http://h/~a)"),  # tildes
    ('<p><img src="u" alt="[@]" width="2" height="3"></p>', "![{2x3} \\[@\\]](u)"),  # images
    ("<p>1. @</p>", "1\\. @"), ("<p>1) @</p>", "1\\) @"), ("<hr><p>@</p>", "---\n\n@"),
    ('<p><a href="http://h/x">http://h/x</a> @</p>', "<http://h/x> @"),
]
PLAIN_TEXT = [
    ("<table><tr><td>@<br>b</td><td>c</td></tr></table><p>x</p>", "@ b c \nx"), ("<p>@</p><p>b</p>", "@\nb"), ("<p>@<br>b</p>", "@\nb"), ("<h1>@</h1><ul><li>b</li></ul>", "@\nb"),
    ("<p>@    b</p>", "@ b"), ("<p>@</p>\n\n\n\n<p>b</p>", "@\n\nb"),
]
ADDRESSES = [  # base, address, resolved
    ("http://h/b/c?d=1", "@.png", "http://h/b/@.png"), ("http://h/b/c", "/x/@", "http://h/x/@"), ("http://h/b/c", "?q=@", "http://h/b/c?q=@"), ("http://h/b/c", "//k/@", "http://k/@"),
    ("http://h/b/c", "data:@", "data:@"), ("http://h/b/c", "mailto:@", "mailto:@"), ("http://h/b/c", "https://k/@", "https://k/@"), ("http://h/b/c", "../@", "http://h/@"),
]


def _quoted(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _expected(values: list, name: str = "c_name") -> str:
    return f"replace(([{', '.join(map(_quoted, values))}])[(c_custkey % {len(values)})::INT + 1], '@', {name})"


def _chosen(values: list[str]) -> Column:
    return F.replace(F.element_at(F.array(*map(F.lit, values)), (F.col("c_custkey") % len(values) + 1).cast("int")), F.lit("@"), F.col("c_name"))


@query("q52_clean_cases", f"SELECT c_custkey, {_expected([x[1] for x in CLEAN])} AS html FROM customer")
def q52(spark, d):
    return table(spark, d, "customer").select("c_custkey", clean_html(_chosen([x[0] for x in CLEAN]), F.lit("http://h.example/b/c")).alias("html"))


@query("q53_markdown_cases", f"SELECT c_custkey, {_expected([x[1] for x in MARKDOWN])} AS md FROM customer")
def q53(spark, d):
    return table(spark, d, "customer").select("c_custkey", textify.html_to_markdown_udf(_chosen([x[0] for x in MARKDOWN])).alias("md"))


@query("q54_text_cases", f"SELECT c_custkey, {_expected([x[1] for x in PLAIN_TEXT])} AS text FROM customer")
def q54(spark, d):
    return table(spark, d, "customer").select("c_custkey", textify.text_from_html(_chosen([x[0] for x in PLAIN_TEXT])).alias("text"))


@query("q55_resolve_cases", f"SELECT c_custkey, {_expected([x[2] for x in ADDRESSES], 'c_nationkey::VARCHAR')} AS url FROM customer")
def q55(spark, d):
    c = table(spark, d, "customer").withColumn("c_name", F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", urls.resolve_url_udf(_chosen([x[1] for x in ADDRESSES]), _chosen([x[0] for x in ADDRESSES])).alias("url"))


@query("q56_normalize_urls_cases", """SELECT c_custkey, '<p onclick="x"><a href="http://h.example/b/f?k=' || c_custkey || '">a</a><img src="http://k.example/i' || c_custkey || '"></p>' AS html FROM customer""")
def q56(spark, d):
    raw = _text('<p onclick="x"><a href="f?k=', key_(), '">a</a><img src="//k.example/i', key_(), '"></p>')
    return table(spark, d, "customer").select("c_custkey", normalize_content_urls(raw, F.lit("http://h.example/b/c")).alias("html"))


@query("q57_image_sizes", """SELECT c_custkey, (c_custkey % 65536)::INT AS w, (c_nationkey + 1)::INT AS h, '<p><img src="u" width="' || (c_custkey % 65536) || '" height="' || (c_nationkey + 1) || '"><img src="v" width="9"></p>' AS html FROM customer""")
def q57(spark, d):
    hex4 = lambda c: F.unhex(F.lpad(F.hex(c), 8, "0"))
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), hex4(F.col("c_custkey") % 65536), hex4((F.col("c_nationkey") + 1).cast("long")))
    sized = table(spark, d, "customer").select("c_custkey", readers.image_size_udf(png).alias("s"))
    sizes = F.array(F.struct(F.lit("u").alias("url"), F.col("s.w").alias("w"), F.col("s.h").alias("h")), F.struct(F.lit("v").alias("url"), F.lit(1).alias("w"), F.lit(1).alias("h")))
    return sized.select("c_custkey", "s.w", "s.h", textify.inject_dimensions(F.lit('<p><img src="u"><img src="v" width="9"></p>'), sizes).alias("html"))


@query("q58_image_addresses", "SELECT c_custkey, 'http://h/' || c_custkey || ',https://k/x,http://h/' || c_custkey AS urls FROM customer")
def q58(spark, d):
    html = _text('<img src="http://h/', key_(), '"><img src="/rel"><img src="https://k/x"><img><img src="data:x"><img src="http://h/', key_(), '">')
    return table(spark, d, "customer").select("c_custkey", F.array_join(textify.absolute_image_urls(html), ",").alias("urls"))
