"""What keeps page work small: few passes over a page, few rows in Python at a time, and the same trees by the quicker reading."""

import hashlib
import random

from pyspark.sql import functions as F

from tidings.functions import clean, dom, textify
from tidings.sources import cells


def test_rules_are_repeated_only_while_they_change_something(spark):
    for rule in (clean.drop_empty, clean.merge_emphasis):
        plan = spark.range(1).select(rule(F.col("id").cast("string")).alias("x"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("regexp_replace") == 1, plan


def test_rows_of_a_page_are_found_one_by_one():
    rows = cells.rows_of("<table>" + "<tr><td>x</td></tr>" * 3 + "</table>", {"listRow": "tr"}, "listRow")
    assert next(rows)["td"] == [("x", None, None, None)] and len(list(rows)) == 2


def test_plain_markup_gives_the_tree_of_the_parser():
    rng = random.Random(7)
    pieces = ["<p>", "</p>", "<b>", "</b>", "<td class='v w'>", "</td>", "<tr>", "</tr>", "<table>", "</table>", "<li>", "<br>", '<a class="t" href="?a=1&amp;b=2">', "</a>", "x &lt; y", " ", "&nbsp", "<IMG SRC='a'  ALT=\"\">", "&amp;c;"]
    odd = ["<!-- c -->", "<a href=x>", "<script>a<b</script>", "<", "<p/>", "< b>", "</ p>", '<a href="&ampx">', "&am"]
    plain = 0
    for k in range(2000):
        html = "".join(rng.choices(pieces + odd * (k % 2), k=rng.randrange(12)))
        b = dom._Builder()
        b.feed(html)
        b.close()
        plain += dom._Builder().feed_plain(html)
        assert dom.parse(html).inner_html() == b.root.inner_html(), html
    assert plain > 1000


def test_cells_as_arrow():
    rows = [{"row": [(None, "", None, None)], "td": [("a", None, "b", "c"), ("d", "e", None, None)]}, None, {}]
    got = cells.arrow_cells(rows).to_pylist()
    assert got[1:] == [[], []] and got[0][1] == ("td", [{"text": "a", "href": None, "inner_text": "b", "inner_href": "c"}, {"text": "d", "href": "e", "inner_text": None, "inner_href": None}])


def test_representations_take_few_steps_of_python(spark):
    pages = spark.sql("SELECT concat('<p>', id, '<img src=\"/i\"></p>') AS html, array(named_struct('url', 'http://h/i', 'w', 4, 'h', 3)) AS sizes FROM range(1)")
    for sizes, steps in ((None, 2), (F.col("sizes"), 3)):
        made = textify.with_representations(pages, F.col("html"), F.lit("http://h/b"), sizes=sizes).select("_r.*")
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == steps, plan
        r = made.first()
        size = ' width="4" height="3"' if sizes is not None else ""
        assert r.cleanHtml == f'<p>0<img src="http://h/i"{size}></p>' and r.contentText == "0" and ("{4x3}" in r.cleanMarkdown) == bool(size)
        assert r.content == '<p>0<img src="http://h/i"></p>'
        assert r.contentHash == hashlib.sha256(b'<p>0<img src="http://h/i"></p>').hexdigest()
