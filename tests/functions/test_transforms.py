import pytest
from pyspark.sql import functions as F

from tidings.functions import marks, textify
from tidings.functions.clean import clean_html, normalize_content_urls
from tidings.functions.dom import parse
from tidings.functions.markdown import html_to_markdown
from tidings.functions.textify import LIMIT, absolute_image_urls, inject_dimensions, text_from_html, with_representations
from tidings.functions.urls import query_value, resolve_url, source_url, with_missing_params, without_param


def applied(spark, made, texts, base=None):
    """The results of a column for some texts, in their order."""
    df = spark.createDataFrame([(i, t, base) for i, t in enumerate(texts)], "i int, html string, base string")
    return [r.out for r in df.select("i", made(F.col("html"), F.col("base")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(("html", "md"), [
    ("<p>x</p><p>y</p>", "x\n\ny"), ("<p>x<br>y</p>", "x  \ny"), ("<h2>T</h2>", "## T"), ("<p>1~2</p>", "1～2"), ("<p>1. x</p>", "1\\. x"), ("<p>1) x</p>", "1\\) x"),
    ("<ol><li>x</li></ol>", "- x"), ("<p>- x</p><p>- y</p>", "- x\n- y"), ("<p>- x<br>- y</p>", "- x\n- y"), ("<p>-&nbsp;x<br>-&nbsp;y</p>", "- x\n- y"),
    ("<ul><li>a<ul><li>b</li></ul></li></ul>", "- a\n  - b"), ("<p>a <u>b</u> c</p>", "a b c"), ("<p>- x</p>", "- x"), ("<p>-x</p><p>-y</p>", "-x\n\n-y"),
    ('<img src="u" width="3" height="4" alt="a">', "![{3x4} a](u)"), ('<img src="u" width="3">', "![{w3}](u)"), ('<img src="u" alt="[a]">', "![\\[a\\]](u)"),
    ('<a href="http://h/~x">t</a>', "[t](http://h/~x)"), ("<strong>x<br>y</strong>", "**x**  \n**y**"), ("<p>● a</p><p>● b</p>", "- a\n- b"), ("", ""), (None, None),
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></table>", "| a | b |\n| --- | --- |\n| 1 | 2 |"),
])
def test_markdown(html, md):
    assert html_to_markdown(html) == md


def test_markdown_never_fuses_bold():
    assert "****" not in html_to_markdown("<p><strong>x</strong><b>y</b></p>")
    out = html_to_markdown("<p><strong>a</strong></p><p><strong>b</strong></p>")
    assert out == "**a**\n\n**b**"
    single = html_to_markdown("<table><tr><td><h3>T</h3><p>b</p></td></tr></table>")
    assert "|" not in single and "---" not in single and "### T" in single
    bold = html_to_markdown("<table><tr><td><b>h</b></td><td><b>k</b></td></tr><tr><td>1</td><td>2</td></tr></table>")
    assert bold.split("\n")[1] == "| --- | --- |"


CLEANED = [
    ('<span style="font-weight:700">x</span>', "<strong>x</strong>"), ('<span style="font-weight:400">x</span>', '<span style="font-weight:400">x</span>'),
    ("<strong>x</strong> <strong>y</strong>", "<strong>x y</strong>"), ("<strong>x</strong>z<strong>y</strong>", "<strong>x</strong>z<strong>y</strong>"),
    ("<strong>x</strong><strong>·</strong><strong>y</strong>", "<strong>x</strong>·<strong>y</strong>"), ("<strong>26</strong>", "<strong>26</strong>"),
    ("<title>t</title>a<script>b</script>", "a"), ("<p>a<p>b<b>c", "<p>a</p><p>b<b>c</b></p>"), ("<div><div><div>x</div></div></div>", "<div>x</div>"),
    ("<p> &nbsp;</p>", None), ("  ", None), (None, None), ('<a href="javascript:x">y</a>', "<a>y</a>"), ("<p onclick='x'>a</p>", "<p>a</p>"),
    ('<em style="text-decoration:underline">x</em>', "x"), ("<section>x</section>", "x"), ('<div class="w3eden">z</div><p>a</p>', "<p>a</p>"),
    ("<p><b>a</b></p><p><b>b</b></p><p><b>c</b></p>", "<p>a</p><p>b</p><p>c</p>"), ("<p><b>a</b></p><p><b>b</b></p>", "<p><b>a</b></p><p><b>b</b></p>"),
    ('<img src=" data:image/png;base64,AAAA">x', "x"), ("<pre>a\nb\n\nc</pre>", "<p>a<br>b</p><p>c</p>"),
    ('<img src="i.png"><a href="?q=1">l</a>', '<img src="http://h/p/i.png"><a href="http://h/p/?q=1">l</a>'),
]


def test_clean(spark):
    assert applied(spark, clean_html, [c[0] for c in CLEANED], "http://h/p/") == [c[1] for c in CLEANED]


def test_clean_by_structure(spark):
    """Rules on nested elements: what is dropped, unwrapped or merged is told by numbers and not by the nearest closing tag."""
    layout = '<table class="a __se_tbl_ext">'
    cases = [
        ('<div class="board-view-nav x"><div>a</div>b</div><p>c</p>', "<p>c</p>"),
        ("<form><form>a</form>b</form>c", "c"),
        (f"{layout}<tr><td>{layout}<tr><td>x</td></tr></table>y</td></tr></table>z", "xyz"),
        (f"{layout}<tr><td><table><tr><td>x</td></tr></table></td></tr></table>", "<table><tr><td>x</td></tr></table>"),
        (f"{layout}loose<caption><b>c</b></caption><tr>more<td>x</td></tr></table>", "x"),
        ("<div> <div><div>x</div> <div>y</div></div></div>", "<div><div>x</div> <div>y</div></div>"),
        ("<div><p><b>a</b></p><p><b>b</b></p></div><p><b>c</b></p>", "<div><p><b>a</b></p><p><b>b</b></p></div><p><b>c</b></p>"),
        ("<p><b>a</b></p> <p><b>b<i>i</i></b><br></p><p><b>c</b><strong>d</strong></p>", "<p>a</p> <p>b<i>i</i><br></p><p>cd</p>"),
        ("<b><i>x</i></b><b><i>y</i></b>", "<b><i>xy</i></b>"),
        ('<span style="font-weight: bold; font-style: italic; color: red">x</span>', '<span style="color:red"><em><strong>x</strong></em></span>'),
        ('<p style="font-weight:700;FONT-STYLE: normal;x:y">a</p>', '<p style="font-weight:700;font-style:normal">a</p>'),
        ('<p title="a &gt; b" lang=ko>1 &lt; 2 &amp; "q" onclick="x" style="y"</p>', '<p>1 &lt; 2 &amp; "q" onclick="x" style="y"</p>'),
        ('<a href="?a=1&b=\'2\'">x</a>', '<a href="http://h/p/?a=1&amp;b=&#x27;2&#x27;">x</a>'),
        ("\ufdd0\ufde1<p>a\ufdd7</p>", "\ufffd\ufffd<p>a\ufffd</p>"),
        ("<p>" * 3 + "a" + "<b></b>" * 3, "<p>a</p>"),
    ]
    assert applied(spark, clean_html, [c[0] for c in cases], "http://h/p/") == [c[1] for c in cases]


def test_clean_of_long_pages(spark):
    """Patterns neither recurse nor go back over a page: a page of a few MB, deep nesting and long runs of bold blocks."""
    n = 20_000
    pages = ["<p><b>a</b></p>" * n, "<p>" + "<b>a</b><br>" * n + "</p>", "<div>" * 200 + "x" + "</div>" * 200, "<p>" + "word " * 400_000 + "</p>", "<script>" + "x<y " * n + "</script><p>a</p>"]
    got = applied(spark, clean_html, pages)
    assert got[0] == "<p>a</p>" * n and got[2] == "<div>x</div>" and got[3] == pages[3] and got[4] == "<p>a</p>"
    assert got[1] == pages[1]


def test_clean_keeps_large_inline_images_and_settles(spark):
    big = "data:image/png;base64," + "A" * 1400
    edge = [f'<img src="data:x,{"A" * k}">' for k in (1365, 1366)]
    messy = '<div><p><span style="color:red">a</span> <b>b</b><b>c</b></p><table><tr><td>x</td></tr></table></div>'
    once, large, *edges = applied(spark, clean_html, [messy, f'<img src="{big}">', *edge], "http://h/")
    assert "A" * 1400 in large and edges == [None, edge[1]]
    assert applied(spark, clean_html, [once], "http://h/") == [once]


def test_text_and_sizes(spark):
    row = "<table><tr><td>a<br>b</td><td>c</td></tr></table><p>x</p>y"
    assert applied(spark, lambda h, _: text_from_html(h), [row, None, "<p>&lt;a&gt; &quot;b&quot; &amp; 'c'</p>"]) == ["a b c \nx\ny", "", "<a> \"b\" & 'c'"]  # a blank before a newline stays
    sizes = F.array(*(F.struct(F.lit(u).alias("url"), F.lit(w).alias("w"), F.lit(h).alias("h")) for u, w, h in (("u", 2, 3), ("v", 4, 5), ('q"', 1, 1), ("u", 6, 7))))
    html = '<img src="u" style="a:b"><img src="v" width="1"><img src="q&quot;"><img>'
    assert applied(spark, lambda h, _: inject_dimensions(h, sizes), [html, "", None]) == ['<img src="u" style="a:b" width="6" height="7"><img src="v" width="1"><img src="q&quot;" width="1" height="1"><img>', "", None]
    assert applied(spark, lambda h, _: absolute_image_urls(h), ['<img src="http://a/b?c&amp;d"><img src="/c"><img src="http://a/b">', None]) == [["http://a/b?c&d", "http://a/b"], []]
    assert applied(spark, lambda h, _: textify.content_hash_expr(h), ["", None]) == [None, None]
    df = spark.createDataFrame([(1, "<p>" + "x" * (LIMIT + 10) + "</p>"), (2, '<script>a<b</script><p style="x: y">b</p>'), (3, None), (4, " ")], "i int, html string")
    got = {r.i: r.r for r in with_representations(df, F.col("html"), F.lit("http://h"), "r").collect()}
    assert set(got[1]) == {None}  # the text then is what the page's reader found
    assert got[2][:4] == ('<script>a<b</script><p style="x: y">b</p>', "<p>b</p>", "b", "b") and len(got[2].contentHash) == 64
    assert tuple(got[3]) == (None,) * 5 and tuple(got[4]) == (" ", None, None, None, None)


def test_numbered_markup():
    assert marks.numbered(None) is None and marks.numbered("") == ""
    page = marks.numbered('<table class="k"><tr><td>a<br></td></tr></table><a href="/x">l</a>', "http://h/")
    assert page.count("<") == page.count(">") and page.count("</") == 4
    assert f'{marks.NOTED}in="k"' in page and f'{marks.NOTED}cell="1"' in page and f'{marks.NOTED}at="http://h/x"' in page and f'{marks.NOTED}scheme="http"' in page


def test_urls():
    assert source_url("http://h/b", "http://x/y") == "http://x/y" and source_url("http://h/b", "?a=1") == "http://h/b?a=1" and source_url("http://h/b/c", "../d") == "http://h/d"
    assert resolve_url("", "http://h") == "" and resolve_url("mailto:a@b", "http://h") == "mailto:a@b" and resolve_url("/x", "http://h/y") == "http://h/x"
    assert query_value("http://h/?name=a%20b+c&x=", "name") == "a b c" and query_value("http://h/?x=", "x") is None
    assert without_param("http://h/p?a=1&refresh=9&b=2", "refresh") == "http://h/p?a=1&b=2"
    assert with_missing_params("a=1&b=", {"b": "2", "c": "3"}) == "a=1&b=&c=3"


def test_normalized_addresses(spark):
    pages = ['<a href="x" style="B: c;" onclick=y>t</a>', "", None, " "]
    assert applied(spark, normalize_content_urls, pages, "http://h/") == ['<a href="http://h/x" style="B: c;" onclick="y">t</a>', "", None, " "]


def test_selectors():
    root = parse('<ul class="l"><li>a</li><li id="x" data-k="v1">b<a href="/f?mode=list">m</a></li></ul><div><p>c</p></div>')
    text = lambda s: [e.text() for e in root.select(s)]
    assert text("ul.l > li") == ["a", "bm"] and text("#x a") == ["m"] and text('a[href*="mode=list"]') == ["m"] and text("li:first-child") == ["a"] and text("li:nth-child(2)") == ["bm"]
    assert text('[data-k^="v"]') == ["bm"] and text("p, a") == ["m", "c"] and text("div > p") == ["c"] and text("ul p") == [] and text("") == []
    with pytest.raises(ValueError):
        root.select("a ~ b")


def test_no_scheme_gets_past_the_list(spark):
    hrefs = ["javascript:alert(1)", "java&#9;script:alert(1)", "java&#10;script:alert(1)", "&#1;javascript:alert(1)", " JavaScript:alert(1)", "vb\u200bscript:x", "file:///etc/passwd"]
    assert applied(spark, clean_html, [f'<p><a href="{href}">x</a></p>' for href in hrefs]) == ["<p><a>x</a></p>"] * len(hrefs)


def test_header_rows_keep_their_bold():
    rows = "<tr><td><strong>A</strong></td><td><b>B</b></td></tr><tr><td>1</td><td>2</td></tr>"
    assert html_to_markdown(f"<table><tbody>{rows}</tbody></table>").split("\n") == ["| **A** | **B** |", "| --- | --- |", "| 1 | 2 |"]
