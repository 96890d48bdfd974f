"""Markdown from sanitised HTML: tree passes, rendering, and line rules afterwards."""

from __future__ import annotations

import re

from tidings.functions.dom import Element, Node, Text, parse

# Fixed values.
BULLETS = "·●○▶▷◆◇※►•"
FULL_TILDE = "～"
BOLD = ("strong", "b")
_BULLET = re.compile(rf"^[{BULLETS}]\s*")
_DASH = re.compile(r"^-\s+")
CELLS = ("td", "th")
MOST_COLUMNS = 1000  # as browsers read a cell's span


def _blank(n: Node) -> bool:
    return isinstance(n, Text) and not n.value.strip()


def _rows(table: Element) -> list[Element]:
    out = []
    for c in table.elements():
        if c.tag == "tr":
            out.append(c)
        elif c.tag in ("thead", "tbody", "tfoot"):
            out += [r for r in c.elements() if r.tag == "tr"]
    return out


def _cells(row: Element) -> list[Element]:
    return [c for c in row.elements() if c.tag in CELLS]


def merge_bold(root: Element) -> None:
    """Bold next to bold becomes one; blank texts between them go."""
    for e in root.find_all(*BOLD):
        if e.parent is None:
            continue
        while True:
            after = e.siblings_after()
            k = next((i for i, n in enumerate(after) if not _blank(n)), None)
            if k is None or not isinstance(after[k], Element) or after[k].tag not in BOLD:
                break
            for n in after[:k]:
                n.remove()
            for c in list(after[k].children):
                e.append(c)
            after[k].remove()


def split_bold_at_breaks(root: Element) -> None:
    for e in root.find_all(*BOLD):
        if e.parent is None or not any(c.tag == "br" for c in e.elements()):
            continue
        out: list[Node] = []
        part = Element(e.tag)
        for c in list(e.children):
            if isinstance(c, Element) and c.tag == "br":
                out += [part, c]
                part = Element(e.tag)
            else:
                part.append(c)
        out.append(part)
        e.replace(*[n for n in out if not (isinstance(n, Element) and n.tag in BOLD and not n.text().strip() and not n.elements())])


def plain_spaces(root: Element) -> None:
    for t in root.strings():
        t.value = t.value.replace("\xa0", " ")


def _listed(root: Element, starts: re.Pattern, breaks_allowed: bool) -> None:
    """Two or more paragraphs in a row that start with a bullet become a list; breaks and blanks between them are ignored."""
    for parent in [root, *root.walk()]:
        run: list[Element] = []
        between: list[Node] = []
        for c in [*parent.children, None]:
            if c is not None and run and (_blank(c) or (isinstance(c, Element) and c.tag == "br")):
                between.append(c)
                continue
            hit = isinstance(c, Element) and c.tag == "p" and starts.match(c.text().lstrip()) and (breaks_allowed or not c.find_all("br"))
            if hit:
                run.append(c)
                continue
            if len(run) >= 2:
                ul = Element("ul")
                at = run[0].index()
                for n in [*between, *run]:
                    if n.parent is parent and (n in run or n.index() < run[-1].index()):
                        n.remove()
                parent.children.insert(min(at, len(parent.children)), ul)
                ul.parent = parent
                for p in run:
                    first = next(t for t in p.strings() if t.value.strip())
                    first.value = starts.sub("", first.value.lstrip(), count=1)
                    ul.append(Element("li", children=list(p.children)))
            run, between = [], []


def unwrap_single_columns(root: Element) -> None:
    for t in root.find_all("table"):
        rows = _rows(t)
        if t.parent is not None and rows and all(len(_cells(r)) <= 1 for r in rows):
            t.replace(*[Element("div", children=list(c.children)) for r in rows for c in _cells(r)])


def _make_header(table: Element, row: Element) -> None:
    for c in _cells(row):
        c.tag = "th"
    row.remove()
    head = Element("thead", children=[row])
    table.children.insert(0, head)
    head.parent = table


def header_rows(root: Element) -> None:
    """The first of several rows of a table without header cells becomes its header, as it is."""
    for t in root.find_all("table"):
        rows = _rows(t)
        if any(c.tag == "th" for r in rows for c in _cells(r)) or t.find_all("thead"):
            continue
        if len(rows) >= 2:
            _make_header(t, rows[0])


def flatten_cells(root: Element) -> None:
    for c in root.find_all(*CELLS):
        _flatten(c, ("p", "div", "h1", "h2", "h3", "h4", "li", "ul", "ol"))


def _flatten(e: Element, tags: tuple[str, ...]) -> None:
    blocks = [b for b in e.walk() if b.tag in tags]
    for b in blocks:
        if b.parent is None:
            continue
        after = [n for n in b.siblings_after() if not _blank(n)]
        tail = [Element("br")] if after else []
        b.replace(*list(b.children), *tail)


def flatten_items(root: Element) -> None:
    for li in root.find_all("li"):
        for b in [c for c in li.elements() if c.tag in ("p", "div")]:
            after = [n for n in b.siblings_after() if not _blank(n) and not (isinstance(n, Element) and n.tag in ("ul", "ol"))]
            b.replace(*list(b.children), *([Element("br")] if after else []))


def preprocess(root: Element) -> None:
    for e in root.find_all("span"):
        e.unwrap()
    merge_bold(root)
    split_bold_at_breaks(root)
    plain_spaces(root)
    _listed(root, _BULLET, True)
    _listed(root, _DASH, False)
    for e in root.find_all("ol"):
        e.tag = "ul"
    unwrap_single_columns(root)
    header_rows(root)
    flatten_cells(root)
    flatten_items(root)


# Rendering

_ESCAPED = re.compile(r"([*_])")
BREAK = "  \n"


def _inline(e: Element) -> str:
    return "".join(_render(c) for c in e.children)


def _squeezed(text: str) -> str:
    return re.sub(r"[ \t\r\n]+", " ", text)


def _wrapped(mark: str, inner: str) -> str:
    """Emphasis around the text, its outer spaces outside."""
    body = inner.strip()
    if not body:
        return inner
    lead, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
    return f"{lead}{mark}{body}{mark}{tail}"


def _image(e: Element) -> str:
    w, h = e.attr("width"), e.attr("height")
    hint = f"{{{w}x{h}}}" if w and h else f"{{w{w}}}" if w else f"{{h{h}}}" if h else ""
    alt = " ".join(x for x in (hint, e.attr("alt").replace("[", "\\[").replace("]", "\\]")) if x)
    title = f' "{e.attr("title")}"' if e.attr("title") else ""
    return f"![{alt}]({e.attr('src')}{title})"


def _link(e: Element) -> str:
    text, href = _inline(e), e.attr("href")
    if not href or not text.strip():
        return text
    if text.replace("\\_", "_").replace("\\*", "*").strip() == href:
        return f"<{href}>"
    lead, tail = text[: len(text) - len(text.lstrip())], text[len(text.rstrip()) :]
    return f"{lead}[{text.strip()}]({href}){tail}"


def _list(e: Element) -> str:
    out = []
    for li in [c for c in e.elements() if c.tag == "li"]:
        own, nested = "", ""
        for c in li.children:
            if isinstance(c, Element) and c.tag in ("ul", "ol"):
                nested += "\n" + "\n".join("  " + x for x in _list(c).strip("\n").split("\n"))
            else:
                own += _render(c)
        own = own.strip().replace("\n", "\n  ")
        out.append(f"- {own}{nested}")
    return "\n\n" + "\n".join(out) + "\n\n"


def _table(e: Element) -> str:
    rows = [[re.sub(r"\s*\n\s*", " ", _inline(c).strip()).replace("|", "\\|") for c in _cells(r) for _ in range(1)] for r in _rows(e)]
    spans = [[int(c.attr("colspan")) if c.attr("colspan").isdigit() else 1 for c in _cells(r)] for r in _rows(e)]
    most = max([MOST_COLUMNS, *map(len, rows)])
    full = [[x for t, n in zip(r, s) for x in [t] + [""] * (min(n, most) - 1)][:most] for r, s in zip(rows, spans)]
    if not full:
        return ""
    width = max(map(len, full))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in full]
    return "\n\n" + "\n".join([lines[0], "| " + " | ".join(["---"] * width) + " |", *lines[1:]]) + "\n\n"


def _render(n: Node) -> str:
    if isinstance(n, Text):
        return _ESCAPED.sub(r"\\\1", _squeezed(n.value))
    tag = n.tag
    if tag == "br":
        return BREAK
    if tag == "hr":
        return "\n\n---\n\n"
    if tag == "img":
        return _image(n)
    if tag == "a":
        return _link(n)
    if tag in BOLD:
        return _wrapped("**", _inline(n))
    if tag in ("em", "i"):
        return _wrapped("*", _inline(n))
    if tag in ("ul", "ol"):
        return _list(n)
    if tag == "table":
        return _table(n)
    if re.fullmatch("h[1-6]", tag):
        return f"\n\n{'#' * int(tag[1])} {_inline(n).strip().replace(BREAK, ' ')}\n\n"
    if tag in ("p", "div", "li"):
        return "\n\n" + _trimmed(_inline(n)) + "\n\n"
    return _inline(n)


def _trimmed(text: str) -> str:
    return re.sub(r"^(?:[ \t]*\n)+|[ \t]+$", "", text.strip(" "))


def full_tildes(md: str) -> str:
    """Tildes in prose as full-width ones; code spans and link targets keep theirs."""
    out, i = [], 0
    while i < len(md):
        if md[i] == "`":
            run = re.match(r"`+", md[i:])[0]
            end = md.find(run, i + len(run))
            stop = end + len(run) if end >= 0 else i + len(run)
            out.append(md[i:stop])
            i = stop
        elif md.startswith("](", i):
            depth, j = 1, i + 2
            while j < len(md) and depth:
                depth += {"(": 1, ")": -1}.get(md[j], 0)
                j += 1
            out.append(md[i:j])
            i = j
        else:
            out.append(FULL_TILDE if md[i] == "~" else md[i])
            i += 1
    return "".join(out)


#: Line rules after rendering, in order.
RULES = (
    (re.compile(r"\n{3,}"), "\n\n"),
    (re.compile(r"\*\*([ \t]*)\*\*"), r"\1"),
    (re.compile(r"\*{3,}"), "**"),
    (re.compile(r"[ \t]{2,}\n(?=- )"), "\n"),
    (re.compile(r"[ \t]{2,}\n(?=\n)"), "\n"),
    (re.compile(r"^(\d+)\. ", re.MULTILINE), r"\1\\. "),
    (re.compile(r"^(\d+)\) ", re.MULTILINE), r"\1\\) "),
)


def postprocess(md: str) -> str:
    lines = []
    for line in md.split("\n"):
        body = line.rstrip()
        lines.append(body + "  " if body and line.endswith("  ") else body)
    md = "\n".join(lines)
    for rule, by in RULES:
        md = rule.sub(by, md)
    return full_tildes(md).strip()


def html_to_markdown(html: str | None) -> str | None:
    """Markdown of sanitised HTML; null for null or what can't be handled, '' for ''."""
    if not html:
        return html
    try:
        root = parse(html)
        preprocess(root)
        return postprocess(_inline(root))
    except (ValueError, RecursionError):
        return None
