"""Rows looked up by their shape give what the tree gives, and such pages aren't read as trees."""

import random

from tidings.functions.dom import parse
from tidings.sources import cells
from tidings.sources.shapes import Rows

FACTS = {"listRow": "tr", "titleLink": "a.t", "date": ".d", "views": "td:nth-child(2)", "meta": "table > tbody td > b", "titleText": "h3", "author": "a[href]"}


def by_tree(html, selectors, row="listRow"):
    return [cells.cells_of(r, selectors, row) for r in parse(html).select(selectors[row])]


def by_shape(html, selectors, row="listRow"):
    return Rows(selectors | cells.OWN, row, lambda r: cells.cells_of(r, selectors, row)).found(html)


def test_pages_of_like_rows_are_not_read_as_trees(monkeypatch):
    row = '<tr><td><a class="t" href="?a=1&amp;no={0}">T {0} &lt;&nbsp;x</a> and <b>more</b></td><td class=\'d\'>{0}</td></tr>\n<tr><td>one</td></tr>'
    pages = ["<table>" + "".join(row.format(k) for k in range(p, p + 5)) + "</table><p>next" for p in range(4)]
    expected = [by_tree(p, FACTS) for p in pages]
    monkeypatch.setattr(cells, "parse", None)
    assert [list(cells.rows_of(p, FACTS, "listRow")) for p in pages] == expected
    assert expected[0][0]["titleLink"] == [("T 0 <\xa0x", "?a=1&no=0", None, None)]


def test_random_pages():
    rng, used = random.Random(3), 0
    inside = ["<td>", "</td>", "<td>x</td>", "<td class='d'> y &amp; z</td>", "<td><b>a</b> c</td>", '<td><a class="t" href="?no=1&amp;k=2">A<i>b</i></a></td>', "<a href='&copy'>q</a>", "<a href=''>q</a>", "<p>", "</p>", "<br>", "<h3><span class='category'>k</span> h</h3>", '<b title="a>b">x > y</b>', "<a title='\"'>&nbsp x</a>", "</div>", "<div>", "<img src='/btn_notice.gif'>", '<a class="t" href="x" href="y">z</a>', "\n", "w"]
    odd = ["<!-- <tr></tr> -->", "<table><tr><td>n</td></tr></table>", "<textarea><tr></tr></textarea>", "<a href=x>", "<", "<TR STYLE='a'>x</TR>", "<td title='<tr>'>v</td>", "<script>a</script>"]
    heads = ["<table>", "<div class='x'><table><tbody>", "", "<p>t<table>", "<p>", "a < b<table>", "<table><tr><td>", "<div><table class='n'>"]
    selectors = [FACTS, FACTS | {"listRow": "table.n > tr"}, FACTS | {"listRow": "tr:nth-child(2)"}, FACTS | {"titleLink": "a[href*=no]"}, FACTS | {"meta": "tr:nth-child(2) td"}, FACTS | {"listRow": ".n tr"}]
    even = [x for x in inside if x not in ("<td>", "</td>", "<p>", "</p>", "<div>", "</div>", "<a href='&copy'>q</a>")]
    for k in range(3000):
        rows = ["<tr%s>%s</tr>" % (rng.choice(["", "", " style='b'"]), "".join(rng.choices(even if k % 3 == 1 else inside + odd * (k % 3 == 0), k=rng.randrange(4)))) for _ in range(3)]
        body = rng.choice(heads) + rng.choice(["", "\n", "x", "</td>"] if k % 4 == 0 else ["", "\n"]).join(rng.choices(rows, k=rng.randrange(7))) + rng.choice(["", "</table>", "</table><div>f</div>", "</td></tr></table>"])
        for s in selectors:
            found = by_shape(body, s)
            used += bool(found)
            assert found is None or found == by_tree(body, s), body
    assert used > 800
    for body in ("<li>x</li><li><b>y</b></li>", "<ul><li>x<ul><li>y</li></ul></li></ul>", "<li>x<li>y"):
        assert by_shape(body, {"listItem": "li", "infoList": "b"}, "listItem") in (None, by_tree(body, {"listItem": "li", "infoList": "b"}, "listItem"))


def test_rows_that_never_repeat_are_left_to_the_tree():
    rows = Rows(FACTS | cells.OWN, "listRow", lambda r: cells.cells_of(r, FACTS, "listRow"))
    assert all(rows.found(f"<table><tr data-k='{k}'><td>x</td></tr></table>") for k in range(500))
    assert rows.found("<table><tr data-k='x'><td>x</td></tr></table>") is None and not rows.usable
