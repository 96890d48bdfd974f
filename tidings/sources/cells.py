"""List pages as rows of cells, and boards' rules as columns.

Python only finds the rows of a page and, in each, what the source's selectors point to: texts and addresses, nothing
else. What they mean is said in columns: numbers, dates, facts in order or by label, pinned rows, parts of titles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.dom import Element, matching, node_attr, node_text, parse
from tidings.functions.textify import first_number, normalize_date_expr, ustrip
from tidings.sources.shapes import Rows

CELL = "struct<text:string,href:string,inner_text:string,inner_href:string>"
CELLS = f"map<string,array<{CELL}>>"
#: What is looked up inside a cell of that name.
INNER = {"td": "a", "titleText": "span.category"}
#: Cells that no selector of a source names. `row` is the row itself, with its style as its address.
OWN = {"td": "td", "notice": 'img[src*="btn_notice"]'}


def cells_of(row: Element, selectors: dict[str, str], row_name: str) -> dict[str, list[tuple]]:
    """What each selector finds in a row: text and address of each element, and of what is looked up inside it. Nothing found has no entry."""
    out = {"row": [(None, row.attr("style"), None, None)]}
    elements = row.below()
    for name, selector in (selectors | OWN).items():
        if name == row_name or not selector:
            continue
        found = []
        for e in [e for e in elements if e.tag == "td"] if name == "td" else matching(elements, selector, row):
            inner = e.select_one(INNER[name]) if name in INNER else None
            found.append((node_text(e), node_attr(e, "href"), node_text(inner) if inner else None, node_attr(inner, "href") if inner else None))
        if found:
            out[name] = found
    return out


def rows_of(body: str, selectors: dict[str, str], row_name: str) -> Iterator[dict[str, list[tuple]]]:
    key = (row_name, *selectors.items())
    if key not in _ROWS:
        if len(_ROWS) >= 100:
            _ROWS.clear()
        _ROWS[key] = Rows(selectors | OWN, row_name, lambda row: cells_of(row, selectors, row_name))
    found = _ROWS[key].found(body)
    return iter(found) if found is not None else (cells_of(row, selectors, row_name) for row in parse(body).select(selectors[row_name]))


_ROWS: dict[tuple, Rows] = {}  # by selectors


def arrow_cells(rows: list[dict[str, list[tuple]] | None]) -> pa.MapArray:
    """Rows' cells as an Arrow array of the type `CELLS`."""
    names, starts, ends, flat = [], [0], [0], []
    for row in rows:
        for name, some in (row or {}).items():
            names.append(name)
            flat += some
            ends.append(len(flat))
        starts.append(len(names))
    parts = zip(*flat) if flat else ((), (), (), ())
    fields = ["text", "href", "inner_text", "inner_href"]
    found = pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in parts], fields)
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)
    return pa.MapArray.from_arrays(pa.array(starts, pa.int32()), pa.array(names, pa.string()), lists)


def _cell(name: str, part: str = "text", k: int = 0) -> Column:
    """A part of the k-th cell of a name; empty where there is none."""
    return F.coalesce(F.get(F.col("cells")[name], F.lit(k))[part], F.lit(""))


def _has(name: str) -> Column:
    return F.coalesce(F.size(F.col("cells")[name]), F.lit(0)) > 0


def _number(href: Column, *patterns: str) -> Column:
    found = [F.when(href.rlike(p), F.regexp_extract(href, p, 1).try_cast("bigint")) for p in patterns]
    return F.coalesce(*found)


def _labelled(name: str) -> Column:
    """The text after `NAME :` among the facts; of several the last."""
    pattern = r"^(.+?)\s*:\s*(.+)$"
    texts = F.transform(F.col("cells")["infoList"], lambda x: x["text"])
    own = F.filter(texts, lambda t: t.rlike(pattern) & (F.upper(ustrip(F.regexp_extract(t, pattern, 1))) == name))
    return F.coalesce(ustrip(F.regexp_extract(F.try_element_at(own, F.lit(-1)), pattern, 2)), F.lit(""))


def item_columns(as_of: str, page: Column) -> dict[str, dict[str, Column]]:
    """By kind of board: each field of a list item, and `keep`, whether the row is an item at all. Rows have `cells` and `source`."""
    href, title = _cell("titleLink", "href"), _cell("titleLink")
    when = F.lit(as_of).cast("date")
    labels = F.coalesce(F.col("source.infoParser") == "labeled", F.lit(False))
    columns = F.coalesce(F.size(F.col("cells")["td"]), F.lit(0))
    facts = {
        "author": F.when(labels, _labelled("WRITER")).otherwise(_cell("infoList", k=1)), "date": F.when(labels, _labelled("POSTED DATE")).otherwise(_cell("infoList", k=2)),
        "views": first_number(F.when(labels, _labelled("HIT")).otherwise(_cell("infoList", k=3))),
    }
    standard = facts | {
        "articleNo": _number(href, r"articleNo=(\d+)", r"itemId=(\d+)"), "title": title, "category": F.regexp_replace(_cell("category"), r"^[\[\]]+|[\[\]]+$", ""), "detailPath": href, "keep": F.lit(True)}
    table = F.coalesce(F.col("source.skinType") == "table", F.lit(False))
    whole = F.when(href.startswith("//"), F.concat(F.lit("https:"), href)).otherwise(href)
    label = _cell("titleText", "inner_text")
    headed = ustrip(F.when(label != "", F.replace(_cell("titleText"), label, F.lit(""))).otherwise(_cell("titleText")))
    named = F.when(~table & _has("titleText"), headed).otherwise(title)
    meta = _cell("meta")
    shown = r"조회수\s*:\s*(\d+)"
    cell_link, hits = _cell("td", "inner_href", 2), _cell("td", k=5)
    pinned = F.contains(F.replace(_cell("row", "href"), F.lit(" "), F.lit("")), F.lit("background:#f4f4f4"))
    return {
        "Standard": standard,
        "AspBoard": standard | {"articleNo": _number(href, r"number=(\d+)"), "title": ustrip(F.regexp_replace(title, "^·+", "")), "category": F.lit("")},
        "Gnuboard": {
            "articleNo": _number(href, r"wr_id=(\d+)"), "title": named, "category": F.lit(""), "author": _cell("author"), "date": normalize_date_expr(_cell("date"), when), "views": first_number(_cell("views")),
            "detailPath": F.when(table, href).otherwise(whole), "keep": (named != "") & (~table | (columns >= 2))},
        "GnuboardCustom": {
            "articleNo": _number(href, r"num=(\d+)"), "title": title, "category": F.lit(""), "author": ustrip(F.substring_index(meta, "|", 1)), "date": _cell("date"), "views": first_number(F.regexp_extract(meta, shown, 1)),
            "detailPath": href, "keep": (columns >= 2) & (title != "") & ((page == 0) | ~_has("notice"))},
        "CustomPhp": {
            "articleNo": _number(href, r"idx=(\d+)"), "title": title, "category": _cell("category"), "author": F.lit(""), "date": _cell("date"), "views": first_number(_cell("views")),
            "detailPath": href, "keep": (columns >= 2) & (title != "")},
        "JspDorm": {
            "articleNo": _number(cell_link, r"article_no=(\d+)"), "title": _cell("td", "inner_text", 2), "category": _cell("td", k=1), "author": F.lit(""), "date": _cell("td", k=4),
            "views": F.when(hits.rlike(r"^\d+$"), first_number(hits)).otherwise(F.lit(0)), "detailPath": cell_link, "keep": (columns >= 6) & ((page == 0) | ~pinned)},
    }


#: The selector of the links to files, by kind of board, and what it is where a source has none.
FILES = {
    "Standard": ("attachmentList", ""), "AspBoard": ("attachmentList", ""), "Gnuboard": ("detailAttachment", ""), "GnuboardCustom": ("detailAttachment", ""),
    "CustomPhp": ("detailAttachment", "div.attachment a[href]"), "JspDorm": ("attachmentLink", ""),
}
LINKS = "array<struct<text:string,href:string,onclick:string>>"


def links_of(root: Element, kind: str, selectors: dict[str, str]) -> list[tuple]:
    """Text, address and script of what a page's selector for files finds."""
    name, default = FILES[kind]
    return [(node_text(a), node_attr(a, "href"), a.attr("onclick")) for a in root.select(selectors.get(name) or default)]


def origin_url_expr(base: Column, path: Column) -> Column:
    """Addresses of files: paths count from the host, queries from the board."""
    origin = F.regexp_extract(base, r"^([^/?#]*//[^/?#]*)", 1)
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return F.when(path.startswith("http"), path).when(path.startswith("?"), F.concat(base, path)).otherwise(F.concat(origin, rooted))


def _file(name: Column, url: Column, referer: Column | None = None) -> Column:
    return F.struct(name.alias("name"), url.alias("url"), (F.lit(None).cast("string") if referer is None else referer).alias("referer"))


def file_columns() -> dict[str, Column]:
    """By kind of board, the files of a page. Rows have `links`, `base`, `onclick` (do scripts hold the addresses?) and `pageUrl`."""
    base, links = F.col("base"), F.col("links")
    text = lambda x: F.coalesce(x["text"], F.lit(""))
    href = lambda x: F.coalesce(x["href"], F.lit(""))
    named = F.filter(links, lambda x: (text(x) != "") & (href(x) != ""))
    from_host = lambda h: F.when(h.startswith("http"), h).otherwise(origin_url_expr(base, F.concat(F.lit("/"), F.regexp_replace(h, "^/+", ""))))

    def shown(x: Column) -> Column:
        script = F.replace(F.regexp_extract(F.coalesce(x["onclick"], F.lit("")), r"location\.href='([^']+)'", 1), F.lit("&amp;"), F.lit("&"))
        return F.when(F.col("onclick"), script).otherwise(href(x))

    standard = F.filter(F.transform(links, lambda x: _file(text(x), shown(x))), lambda x: (x["name"] != "") & (x["url"] != "") & (x["url"] != "#"))
    whole = lambda h: F.when(h.startswith("//"), F.concat(F.lit("https:"), h)).when(h.startswith("?"), F.concat(F.lit("/"), h)).otherwise(h)
    with_referer = F.transform(named, lambda x: _file(text(x), origin_url_expr(base, whole(href(x))), F.col("pageUrl")))
    folder = F.regexp_replace(base, "/[^/]*$", "")
    placed = lambda h: F.when(h.startswith("http"), h).when(h.startswith("/"), origin_url_expr(base, h)).otherwise(F.concat(folder, F.lit("/"), F.regexp_replace(h, r"^\./", "")))
    some = F.filter(links, lambda x: (href(x) != "") & (href(x) != "#"))
    asked = lambda u: F.nullif(F.try_url_decode(F.regexp_extract(u, r"[?&]name=([^&#]+)", 1)), F.lit(""))
    located = F.transform(F.transform(some, lambda x: _file(text(x), placed(href(x)))), lambda x: x.withField("name", F.coalesce(asked(x["url"]), F.nullif(x["name"], F.lit("")), F.substring_index(x["url"], "/", -1))))
    located = F.filter(located, lambda x: x["name"] != "")
    first = F.filter(located, lambda x, i: F.array_position(F.transform(located, lambda y: y["url"]), x["url"]) == i + 1)
    return {
        "Standard": F.transform(standard, lambda x: x.withField("url", origin_url_expr(base, x["url"]))),
        "AspBoard": F.transform(F.filter(named, lambda x: href(x) != "#"), lambda x: _file(text(x), from_host(href(x)))),
        "Gnuboard": with_referer, "GnuboardCustom": with_referer, "CustomPhp": first, "JspDorm": F.transform(named, lambda x: _file(text(x), from_host(href(x)))),
    }
