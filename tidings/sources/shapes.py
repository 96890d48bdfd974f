"""List pages whose rows repeat one another but for texts and addresses: what a row's selectors find is worked out once for each
shape of a row, and then only looked up.

A shape is a row's markup with holes for its texts and for the values of some attributes. Pages where this could differ from
reading the whole tree (markup that isn't plain, rows left open or nested, selectors that look at siblings) are read as trees.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape
from operator import itemgetter

from tidings.functions.dom import _UNUSUAL, Element, Text, _Builder, _compiled

Cells = dict[str, list[tuple]]
#: Attributes whose values are holes. No selector may ask for their values.
FREE = frozenset({"href", "title", "onclick"})
_HOLES = re.compile("(" + "|".join(["(?<=>)[^<]+", *(rf"(?<=[ \n]{a}=[\"'])[^\"'<>]+" for a in sorted(FREE))]) + ")")
_MARK = re.compile("\ufdd0([0-9]+)\ufdd1")
#: Shapes kept for a source: where there are more, a page's rows don't repeat one another.
MOST = 500


class _Strict(_Builder):
    """Notes whether every element was closed by its own tag."""

    strict = True

    def _close(self, tags, stop):
        n = len(self.open)
        super()._close(tags, stop)
        self.strict &= n == len(self.open)

    def handle_endtag(self, tag):
        self.strict &= self.open[-1].tag == tag
        super().handle_endtag(tag)


class Shape:
    """Where in the holes of a row, which hold texts and attributes, a row's cells lie; and the shape of the row that came next."""

    def __init__(self, parts: list[str], around: tuple, joined: list[list[int]], wanted: list[int], constants: list, layout: list[tuple[str, range]]):
        fixed = parts[::2]
        self.attributes = [i for i, x in enumerate(fixed[:-1]) if x[-1] != ">"]
        holes = ["([^\"'<>]+)" if i in self.attributes else "([^<]+)" for i in range(len(fixed) - 1)]
        self.pattern = re.compile("".join(re.escape(x) + h for x, h in zip(fixed, [*holes, "[^<]*"])))
        self.around, self.joined, self.constants, self.layout, self.next = around, joined, constants, layout, None
        self.take = itemgetter(*wanted) if len(wanted) > 1 else lambda held: tuple(held[i] for i in wanted)

    def cells(self, holes: tuple[str, ...]) -> Cells | None:
        """A row's cells; None where a reference in an attribute needs the parser's care."""
        held = [(_unescaped(x) if "&" in x else x).strip() for x in holes]
        for i in self.attributes:
            x = holes[i]
            if "&" in x:
                if _UNUSUAL.search(x):
                    return None
                x = _unescaped(x)
            held[i] = x
        held += self.constants
        for some in self.joined:
            held.append("".join([held[i] for i in some]))
        flat = self.take(held)
        return {name: [flat[i : i + 4] for i in at] for name, at in self.layout}


def _unescaped(x: str) -> str:
    if _UNUSUAL.search(x):
        return unescape(x)
    return x.replace("&lt;", "<").replace("&gt;", ">").replace("&quot;", '"').replace("&#39;", "'").replace("&amp;", "&")


class Rows:
    """The rows of one source's pages. `read` finds the cells of a row of a tree."""

    def __init__(self, selectors: dict[str, str], row_name: str, read: Callable[[Element], Cells]):
        self.selector, self.read = selectors[row_name], read
        self.shapes: dict[tuple, Shape | None] = {}
        self.firsts: dict[tuple, Shape] = {}
        rows, inside = _compiled(self.selector), [p for name, s in selectors.items() if name != row_name and s for p in _compiled(s)]
        tags = [c[1] for c in rows[0][-1][1] if c[0] == "tag" and c[1] != "*"] if len(rows) == 1 else []
        steps = [c for p in (*rows, *inside) for _, conditions in p for c in conditions]
        above = [c for p in rows for _, conditions in p for c in conditions] + [c for p in inside for _, conditions in p[:-1] for c in conditions]
        free = any(c[0] == "attr" and c[1].lower() in FREE and c[2] for c in steps)
        self.usable = bool(tags) and not free and not any(c[0] == "nth" for c in above)
        if self.usable:
            self.starts = re.compile(rf"<{tags[0]}[ \n>]", re.IGNORECASE)
            self.end = re.compile(f"</{tags[0]}>", re.IGNORECASE)

    def found(self, body: str) -> list[Cells] | None:
        """The cells of each row; None for a page that must be read as a tree."""
        if not self.usable:
            return None
        start = self.starts.search(body)
        at = start.start() if start else len(body)
        above = _Builder()
        if not above.feed_plain(body[:at]) or above.root.select(self.selector):
            return None
        around = tuple((e.tag, *e.attrs.items()) for e in above.open[1:])
        out, before = [], None
        while start:
            shape = before.next if before else self.firsts.get(around)
            m = shape.pattern.match(body, at) if shape and shape.around == around else None
            if m is None:
                shape = self.shape_at(body, at, around, above)
                m = shape and shape.pattern.match(body, at)
                if not m:
                    return None
                if before:
                    before.next = shape
                else:
                    self.firsts[around] = shape
            cells = shape.cells(m.groups())
            if cells is None:
                return None
            if cells:
                out.append(cells)
            at, before = m.end(), shape
            start = self.starts.match(body, at)
        tail = body[at:]
        return out if not tail or (not self.starts.search(tail) and _Builder().feed_plain(tail)) else None

    def shape_at(self, body: str, at: int, around: tuple, above: _Builder) -> Shape | None:
        end, later = self.end.search(body, at), self.starts.search(body, at + 1)
        if end is None or (later and later.start() < end.start()):
            return None
        parts = _HOLES.split(body[at : end.end()])
        key = (around, *parts[::2])
        if key not in self.shapes:
            if len(self.shapes) >= MOST:
                self.usable, self.shapes, self.firsts = False, {}, {}
                return None
            self.shapes[key] = self.shape_of(parts, around, above)
        return self.shapes[key]

    def shape_of(self, parts: list[str], around: tuple, above: _Builder) -> Shape | None:
        n = len(parts) // 2
        html = "".join(x if i % 2 == 0 else f"\ufdd0{i // 2}\ufdd1" for i, x in enumerate(parts))
        if any("\ufdd0" in x or "\ufdd1" in x for x in parts):
            return None
        alone = _Strict()
        if not alone.feed_plain(html) or not alone.strict or len(alone.open) > 1 or len(alone.root.children) != 1:
            return None
        b = _Builder()
        for e in above.open[1:]:
            x = Element(e.tag, dict(e.attrs))
            b.open[-1].append(x)
            b.open.append(x)
        opened = list(b.open)
        if not b.feed_plain(html) or len(b.open) != len(opened) or any(x is not y for x, y in zip(b.open, opened)) or any(len(x.children) != 1 for x in opened):
            return None
        row = opened[-1].children[0]
        if not isinstance(row, Element):
            return None
        for e in (row, *row.below()):
            values = [*e.attrs.values(), *(c.value for c in e.children if isinstance(c, Text))]
            if any(_MARK.search(v) and not _MARK.fullmatch(v) for v in values):
                return None
        if not any(e is row for e in b.root.select(self.selector)):
            return Shape(parts, around, [], [], [], [])
        constants: list = []
        joined: list[list[int]] = []
        wanted: list[tuple[str, int]] = []
        layout, at = [], 0
        for name, cells in self.read(row).items():
            layout.append((name, range(at, at + 4 * len(cells), 4)))
            at += 4 * len(cells)
            for value in (v for cell in cells for v in cell):
                marks = [int(x) for x in _MARK.findall(value or "")]
                if not marks:
                    wanted.append(("constant", len(constants)))
                    constants.append(value)
                elif len(marks) == 1:
                    wanted.append(("hole", marks[0]))
                else:
                    wanted.append(("joined", len(joined)))
                    joined.append(marks)
        first = {"hole": 0, "constant": n, "joined": n + len(constants)}
        return Shape(parts, around, joined, [first[kind] + i for kind, i in wanted], constants, layout)

