"""A small HTML tree on the standard library: parsing with implied end tags, CSS selection, serialisation.

Covers what notice pages need. Markup is repaired as browsers do for unclosed paragraphs, list items, cells and bold runs;
no claim is made to equal any particular HTML library on badly nested input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape, unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends an open element of these names, unless one of the second set stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}),
    "thead": ({"tr", "td", "th", "tbody", "thead"}, {"table"}), "tbody": ({"tr", "td", "th", "tbody", "thead"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead"}, {"table"}),
}
#: A block ends an open paragraph, unless one of these stands between.
PARAGRAPH, HOLDS_PARAGRAPHS = frozenset({"p"}), frozenset("td th table div li blockquote button".split())


class Node:
    __slots__ = ("parent",)

    def index(self) -> int:
        return next(i for i, x in enumerate(self.parent.children) if x is self)

    def remove(self) -> None:
        if self.parent is not None:
            del self.parent.children[self.index()]
            self.parent = None

    def replace(self, *nodes: Node) -> None:
        at, parent = self.index(), self.parent
        for n in nodes:
            n.remove()
        at = self.index()
        parent.children[at : at + 1] = nodes
        for n in nodes:
            n.parent = parent
        self.parent = None

    def siblings_after(self) -> list[Node]:
        return self.parent.children[self.index() + 1 :]


class Text(Node):
    __slots__ = ("value",)

    def __init__(self, value: str):
        self.value, self.parent = value, None


class Element(Node):
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, children: list[Node] | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], None
        if children:
            for c in children:
                self.append(c)

    def append(self, node: Node) -> None:
        node.remove()
        node.parent = self
        self.children.append(node)

    def walk(self) -> Iterator[Element]:
        """Elements below, in document order; the tree may change while walking."""
        for c in list(self.children):
            if isinstance(c, Element):
                yield c
                yield from c.walk()

    def below(self) -> list[Element]:
        """Elements below, in document order, as they are now."""
        out, todo = [], self.children[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, Element):
                out.append(x)
                todo += x.children[::-1]
        return out

    def find_all(self, *tags: str) -> list[Element]:
        return [e for e in self.walk() if e.tag in tags]

    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]

    def text(self) -> str:
        return "".join(c.value if isinstance(c, Text) else c.text() for c in self.children)

    def strings(self) -> Iterator[Text]:
        for c in list(self.children):
            if isinstance(c, Text):
                yield c
            else:
                yield from c.strings()

    def unwrap(self) -> None:
        self.replace(*list(self.children))

    def clear(self) -> None:
        for c in list(self.children):
            c.remove()

    def attr(self, name: str) -> str:
        return self.attrs.get(name) or ""

    def classes(self) -> list[str]:
        return self.attr("class").split()

    def inner_html(self) -> str:
        return "".join(_html(c) for c in self.children)

    def select(self, selector: str) -> list[Element]:
        """Elements below that match, in document order. An empty selector matches nothing."""
        return matching(self.below(), selector, self)

    def select_one(self, selector: str) -> Element | None:
        return next(iter(self.select(selector)), None)


def _html(node: Node) -> str:
    if isinstance(node, Text):
        return escape(node.value, quote=False)
    attrs = "".join(f' {k}="{escape(v or "")}"' for k, v in node.attrs.items())
    if node.tag in VOID:
        return f"<{node.tag}{attrs}>"
    if node.tag in ("script", "style"):
        return f"<{node.tag}{attrs}>{node.text()}</{node.tag}>"
    return f"<{node.tag}{attrs}>{node.inner_html()}</{node.tag}>"


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#root")
        self.open = [self.root]

    def _close(self, tags: set[str], stop: set[str]) -> None:
        above = self.open
        for i in range(len(above) - 1, 0, -1):
            tag = above[i].tag
            if tag in tags:
                del above[i:]
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS:
            names, stop = ENDS[tag]
            for _ in range(len(names)):
                self._close(names, stop)
        if tag in BLOCK:
            self._close(PARAGRAPH, HOLDS_PARAGRAPHS)
        e = Element(tag, {k: v or "" for k, v in attrs} if attrs else None)
        e.parent = self.open[-1]
        e.parent.children.append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("td", "th", "table") and tag in ("p", "b", "strong", "i", "em", "span", "div"):
                return

    def handle_data(self, data):
        e = self.open[-1]
        last = e.children[-1] if e.children else None
        if isinstance(last, Text):
            last.value += data
        else:
            text = Text(data)
            text.parent = e
            e.children.append(text)

    def feed_plain(self, html: str) -> bool:
        """Takes markup of plain tags alone, which need none of the parser's care. False where there is other markup: the tree is of no use then."""
        at = 0
        while m := _PLAIN.match(html, at):
            text, closed, tag, attrs = m.groups()
            if text:
                self.handle_data(unescape(text) if "&" in text else text)
            if tag:
                tag = tag.lower()
                if tag in self.CDATA_CONTENT_ELEMENTS or tag in _RAW or (attrs and _UNUSUAL.search(attrs)):
                    return False
                found = _ATTRIBUTE.findall(attrs) if attrs else ()
                self.handle_starttag(tag, [(k.lower(), unescape(v[1:-1])) for k, v in found] if attrs and "&" in attrs else [(k.lower(), v[1:-1]) for k, v in found])
            elif closed:
                self.handle_endtag(closed.lower())
            else:
                return m.end() == len(html)
            at = m.end()
        return False


#: A text, and a closing tag, an opening one whose attributes are all in quotes, or the end. Then attributes, and references whose reading depends on what follows.
_PLAIN = re.compile(r"""([^<]*)(?:</([A-Za-z][A-Za-z0-9]*)>|<([A-Za-z][A-Za-z0-9]*)((?:[ \n]+[A-Za-z][A-Za-z0-9-]*=(?:"[^"]*"|'[^']*'))*)>|\Z)""")
_ATTRIBUTE = re.compile(r"""[ \n]+([A-Za-z][A-Za-z0-9-]*)=("[^"]*"|'[^']*')""")
_UNUSUAL = re.compile("&(?!(?:amp|lt|gt|quot|#39);)")
#: Elements that parsers of some versions read as text.
_RAW = frozenset("iframe noembed noframes noscript plaintext textarea title xmp".split())


def parse(html: str) -> Element:
    """The tree of a page or fragment, under a nameless root."""
    b = _Builder()
    if b.feed_plain(html):
        return b.root
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def body_of(root: Element) -> Element:
    return next((e for e in root.walk() if e.tag == "body"), root)


_STEP = re.compile(
    r"""\s*(?P<comb>[>,])\s*|(?P<space>\s+)|(?P<tag>[A-Za-z][\w-]*|\*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)
    |\[(?P<attr>[\w-]+)(?:(?P<op>[*^$]?=)(?P<q>["']?)(?P<val>.*?)(?P=q))?\]|:(?P<pseudo>first-child|last-child|nth-child\((?P<n>\d+)\))""",
    re.VERBOSE,
)
_CACHE: dict[str, list] = {}
_NAMED: dict[str, tuple[str, str] | None] = {}


def _compiled(selector: str) -> list[list[tuple[str, list]]]:
    """Alternatives; each a list of (combinator before it, conditions), outermost first."""
    if selector in _CACHE:
        return _CACHE[selector]
    out, at, text = [], 0, selector.strip()
    path: list[tuple[str, list]] = []
    simple: list = []
    comb = " "

    def flush():
        nonlocal simple
        if simple:
            path.append((comb, simple))
            simple = []

    while at < len(text):
        m = _STEP.match(text, at)
        if not m:
            raise ValueError(f"unsupported selector: {selector!r}")
        at = m.end()
        if m["comb"] == ",":
            flush()
            out.append(path)
            path, comb = [], " "
        elif m["comb"] == ">":
            flush()
            comb = ">"
        elif m["space"]:
            flush()
            comb = " "
        elif m["tag"]:
            simple.append(("tag", m["tag"].lower()))
        elif m["cls"]:
            simple.append(("class", m["cls"]))
        elif m["id"]:
            simple.append(("id", m["id"]))
        elif m["attr"]:
            simple.append(("attr", m["attr"], m["op"], m["val"]))
        else:
            simple.append(("nth", int(m["n"]) if m["n"] else 1 if m["pseudo"].startswith("first") else -1))
    flush()
    if path:
        out.append(path)
    if len(_CACHE) < 4096:
        _CACHE[selector] = out
    return out


def _named(paths: list) -> tuple[str, str] | None:
    """Name and class, or '', of a selector that asks for nothing else, as most do."""
    if len(paths) != 1 or len(paths[0]) != 1 or paths[0][0][0] != " ":
        return None
    asked = dict(c[:2] for c in paths[0][0][1])
    plain = len(asked) == len(paths[0][0][1]) and asked.keys() <= {"tag", "class"} and asked.get("tag") != "*"
    return (asked.get("tag", ""), asked.get("class", "")) if plain else None


def matching(elements: list[Element], selector: str, scope: Element) -> list[Element]:
    """Those of the elements below a scope that match."""
    paths = _compiled(selector)
    if selector not in _NAMED:
        if len(_NAMED) >= 4096:
            _NAMED.clear()
        _NAMED[selector] = _named(paths)
    if named := _NAMED[selector]:
        tag, cls = named
        some = [e for e in elements if e.tag == tag] if tag else elements
        return [e for e in some if e.attrs and cls in e.attr("class").split()] if cls else some
    return [e for e in elements if any(_matches(e, p, scope) for p in paths)]


def _holds(e: Element, conditions: list) -> bool:
    for c in conditions:
        if c[0] == "tag":
            ok = c[1] in ("*", e.tag)
        elif c[0] == "class":
            ok = c[1] in e.classes()
        elif c[0] == "id":
            ok = e.attr("id") == c[1]
        elif c[0] == "nth":
            peers = e.parent.elements()
            ok = peers[-1] is e if c[1] == -1 else len(peers) >= c[1] and peers[c[1] - 1] is e
        else:
            value = e.attrs.get(c[1])
            ok = value is not None and {None: lambda: True, "=": lambda: value == c[3], "*=": lambda: c[3] in value, "^=": lambda: value.startswith(c[3]), "$=": lambda: value.endswith(c[3])}[c[2]]()
        if not ok:
            return False
    return True


def _matches(e: Element, path: list, scope: Element) -> bool:
    if not _holds(e, path[-1][1]):
        return False
    if len(path) == 1:
        return path[0][0] == " " or e.parent is scope
    up, comb = e.parent, path[-1][0]
    while up is not None and up.tag != "#root":
        if _matches(up, path[:-1], scope):
            return True
        if comb == ">":
            return False
        up = up.parent
    return False


def node_text(e: Element | None) -> str:
    """Text of a node, every piece stripped and joined; '' for none."""
    if e is None:
        return ""
    out, todo = [], e.children[::-1]
    while todo:
        x = todo.pop()
        if isinstance(x, Text):
            out.append(x.value.strip())
        else:
            todo += x.children[::-1]
    return "".join(out)


def node_attr(e: Element | None, name: str) -> str | None:
    return e.attrs.get(name) if e is not None else None
