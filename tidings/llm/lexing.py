"""Assignment-aware lexing: name-literal pairs of source code and configuration, with constants carried along.

One pass over a text stops at quotes, comments, braces, line ends and assignment operators only. Comments and the insides of
strings are read afterwards, each with constants of its own. Constants live in the block, function or comment that
declares them. A value keeps its length, its characters' counts and references to the values it is made of, never copies; so
`b = a + a` costs the same however long `a` has grown, and what is learned of a value is handed down to its literals
once, at the end.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

EDGE = 64  # characters kept of both ends of a value; a shorter one is kept whole

_STOPS = {
    "code": re.compile(r"""["'`{}=:\n]|\#|//|/\*|<!--"""),
    "comment": re.compile(r"""["'`{}=:\n]"""),
    "string": re.compile(r"[{}=:\n]"),
}
_ASSIGNS = re.compile(r"(?::=|=>|=(?![=~])|:(?![:/]))[ \t]*")
_LINE = re.compile(r"([ \t]*)(?:(?:async[ \t]+)?(def|class)[ \t]+[A-Za-z_]|\[\[?([A-Za-z0-9_. \t\"'-]+)\]\]?[ \t]*(?=[\r\n#;]|\Z))?")
_TYPE = re.compile(r"""[ \t]*&?(?:'[a-z_]+[ \t]+)?(?:mut[ \t]+)?[A-Za-z_][A-Za-z0-9_.:]*(?:[\[<][A-Za-z0-9_.,|?"'\[\]<> \t]*[\]>])?(?:\[\])?[?!]?(?:[ \t]*\|[ \t]*[A-Za-z_][A-Za-z0-9_.]*)*[ \t]*""")
_QUOTE = re.compile(r"""[rbfuRBFU$@]{0,2}(\"\"\"|'''|["'`])""")
_CLOSED = {'"': re.compile(r'(?:[^"\\\n]|\\.)*"'), "'": re.compile(r"(?:[^'\\\n]|\\.)*'")}
_ESCAPED = re.compile(r"""\\(["'])([^\\\n]*)\\\1""")
_BARE = re.compile(r"[A-Za-z0-9+/_.=@!#%^&*~?-]+")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")
_REFERENCE = re.compile(r"\$(?:\{([A-Za-z_][A-Za-z0-9_.]*)\}|([A-Za-z_][A-Za-z0-9_]*))")
_OPERAND = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*(?:\((?:[^()\n]|\([^()\n]*\))*\)|\[[^\[\]\n]*\])*|[0-9]+")
_INSERT = re.compile(r"[$#]?\{([A-Za-z_][A-Za-z0-9_.]*)\}")
_JOIN = re.compile(r"[ \t]*(?:\\?\r?\n[ \t]*)?(?:\+(?!=)|\.\.|\|\||\?\?|[ \t]\.(?=[ \t])|[ \t]or(?=[ \t]))[ \t]*(?:\\?\r?\n[ \t]*)?")
_NEXT_TO = re.compile(r"[ \t]*(?:\\\r?\n[ \t]*)?(?=[rbfuRBFU$@]{0,2}[\"'])")
_GAP = re.compile(r"(?:[ \t\r\n]+|\#[^\n]*|//[^\n]*|/\*(?:[^*]|\*(?!/))*\*/)*")
_AGAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*[ \t]*=(?![=>~])")
_BLOCK = re.compile(r"[|>][+-]?[0-9]*[ \t]*(?:\#[^\n]*)?\r?\n")
_DECLARES = re.compile(r"\b(?:let|const|var|my|local|final|val|static|auto|char|string|String|str)\b[^\n;{}()]*$")
_NAME_CHARACTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-")
_BEFORE_STRING = frozenset("=:,([{+&|?<>;}!\n")


@dataclass(slots=True, eq=False)
class Value:
    """What is known of a value. `span`: its place, if it is a literal; `parts`: the values it was made of."""

    n: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    head: str = ""
    tail: str = ""
    parts: tuple = ()
    span: tuple[int, int] | None = None
    separate: bool = False  # lines of a block, each a value by itself
    constant: bool = True  # a quoted one: may be named without a `$`
    best: float = 0.0
    name: str = ""

    @property
    def edges(self) -> str:
        return self.head if self.n <= EDGE else self.head + self.tail


def literal_value(text: str, start: int, end: int, constant: bool = True) -> Value:
    value = text[start:end]
    return Value(len(value), Counter(value), value[:EDGE], value[-EDGE:], (), (start, end), False, constant)


def _joined(parts: list[Value]) -> Value:
    if len(parts) == 1:
        return parts[0]
    counts = dict(parts[0].counts)
    head, tail = parts[0].head, parts[0].tail
    for p in parts[1:]:
        for c, n in p.counts.items():
            counts[c] = counts.get(c, 0) + n
        head = head if len(head) == EDGE else (head + p.head)[:EDGE]
        tail = (tail + p.tail)[-EDGE:]
    return Value(sum(p.n for p in parts), counts, head, tail, tuple(parts))


@dataclass(slots=True)
class _Frame:
    """An open brace, function or nested key. `undo`: what its constants hid, if it is a scope."""

    kind: str  # brace, indent, key
    indent: int
    names: tuple[str, ...]
    undo: list | None


class Lexer:
    """Name-literal pairs of one text: `pairs` holds (names, enclosing names, value) in order of appearance."""

    def __init__(self, text: str):
        self.text, self.pairs, self.values = text, [], []
        self.missing: dict[str, int] = {}  # closing quotes known not to come after a place
        todo = [("code", 0, len(text))]
        while todo:
            kind, begin, end = todo.pop()
            self.inner: list[tuple[str, int, int]] = []
            self._scan(kind, begin, end)
            todo += self.inner

    # Scanning

    def _scan(self, kind: str, begin: int, end: int) -> None:
        text, stops = self.text, _STOPS[kind]
        self.begin, self.end, self.kind = begin, end, kind
        self.known: dict[str, Value] = {}
        self.frames: list[_Frame] = []
        self.scopes: list[list] = []
        self.section: tuple[str, ...] = ()
        self.pending: tuple[str, ...] = ()  # the name that a brace opens
        self.last_string = (-1, -1)
        self.colon, self.carried, self.run = None, (-1, []), (-1, -1, Counter())
        self.line, self.indent = begin, 0
        self._line(begin)
        at = begin
        while m := stops.search(text, at, end):
            p, stop = m.start(), m[0]
            if stop == "\n":
                self._line(p + 1)
                at = p + 1
            elif stop in ("=", ":"):
                at = self._assignment(p)
            elif stop == "{":
                self._open(p)
                at = p + 1
            elif stop == "}":
                self._close()
                at = p + 1
            elif stop in ('"', "'", "`"):
                at = self._string(p)
            else:
                at = self._comment(p, stop)

    def _line(self, at: int) -> None:
        """What a line's beginning says: ends of functions and nested keys, a new function, a section."""
        if at >= self.end:
            return
        m = _LINE.match(self.text, at, self.end)
        if self.text[m.end(1) : m.end(1) + 1] in ("\n", "\r", ""):
            return
        indent = m.end(1) - at
        self.line, self.indent = at, indent
        while self.frames and self.frames[-1].kind != "brace" and self.frames[-1].indent >= indent:
            self._drop()
        if m[2]:
            self._push("indent", indent, (), scope=True)
        elif m[3]:
            self.section = (m[3].strip(" \t\"'"),)

    def _push(self, kind: str, indent: int, names: tuple[str, ...], scope: bool = False) -> None:
        undo: list | None = [] if scope else None
        if scope:
            self.scopes.append(undo)
        self.frames.append(_Frame(kind, indent, self._enclosing()[-3:] + names, undo))

    def _drop(self) -> None:
        frame = self.frames.pop()
        if frame.undo is not None:
            self.scopes.pop()
            for name, value in reversed(frame.undo):
                if value is None:
                    self.known.pop(name, None)
                else:
                    self.known[name] = value

    def _open(self, p: int) -> None:
        before = self._blanks_before(p)
        last = self.text[before - 1] if before > self.begin else ""
        block = not self.pending and (last == ")" or last.isalnum() or last == "_")
        self._push("brace", -1, self.pending, scope=block)
        self.pending = ()

    def _close(self) -> None:
        while self.frames and self.frames[-1].kind == "key":
            self._drop()
        if self.frames and self.frames[-1].kind == "brace":
            self._drop()

    def _enclosing(self) -> tuple[str, ...]:
        return self.frames[-1].names if self.frames else self.section

    def _comment(self, p: int, sign: str) -> int:
        text = self.text
        if sign in ("#", "//"):
            if p > self.begin and not text[p - 1].isspace() and not (sign == "//" and text[p - 1] in ";{}),"):
                return p + 1
            end = text.find("\n", p, self.end)
            end = self.end if end < 0 else end
        else:
            end = self._find("*/" if sign == "/*" else "-->", p + len(sign))
            if end < 0:
                return p + len(sign)
        self.inner.append(("comment", p + len(sign), end))
        return end

    def _find(self, what: str, at: int) -> int:
        """Where `what` comes next in this region, -1 if nowhere; each is looked for in vain only once."""
        if self.missing.get(what, 1 << 62) <= at:
            return -1
        found = self.text.find(what, at)
        if found < 0:
            self.missing[what] = at
        return found if 0 <= found and found + len(what) <= self.end else -1

    def _quoted(self, at: int) -> tuple[int, int, int] | None:
        """Inner start, inner end and end of a string at `at`."""
        if m := _ESCAPED.match(self.text, at, self.end):
            return m.start(2), m.end(2), m.end()
        m = _QUOTE.match(self.text, at, self.end)
        if not m:
            return None
        if m[1] in _CLOSED:
            closed = _CLOSED[m[1]].match(self.text, m.end(), self.end)
            return (m.end(), closed.end() - 1, closed.end()) if closed else None
        end = self._find(m[1], m.end())
        return (m.end(), end, end + len(m[1])) if end >= 0 else None

    def _string(self, p: int) -> int:
        """Skip a string that is no value; what it says inside is read later. An apostrophe begins none."""
        at = p
        while at > max(self.begin, p - 2) and self.text[at - 1] in "rbfuRBFU$@":
            at -= 1
        before = self._blanks_before(at)
        if before > self.begin and self.text[before - 1] not in _BEFORE_STRING:
            return p + 1
        found = self._quoted(p)
        if not found:
            return p + 1
        self._inside(*found[:2])
        self.last_string = (found[0], found[2])
        return found[2]

    def _inside(self, start: int, end: int) -> None:
        if self.text.find("=", start, end) >= 0 or self.text.find(":", start, end) >= 0:
            self.inner.append(("string", start, end))

    def _blanks_before(self, at: int) -> int:
        while at > self.begin and self.text[at - 1] in " \t":
            at -= 1
        return at

    # Assignments

    def _name_before(self, at: int) -> tuple[str, int]:
        """The name that ends before `at`, bare, quoted or in brackets, and where it begins."""
        text = self.text
        at = self._blanks_before(at)
        if at > self.begin and text[at - 1] == "]":
            at -= 1
        if self.last_string[1] == at:
            return text[self.last_string[0] : at - 1], self.last_string[0] - 1
        if at > self.begin and text[at - 1] in "\"'":
            at -= 1
            at -= at > self.begin and text[at - 1] == "\\"
        end = at
        while at > self.begin and text[at - 1] in _NAME_CHARACTERS:
            at -= 1
        name = text[at:end].lstrip("0123456789.-")
        return (name, end - len(name)) if name else ("", end)

    def _assignment(self, p: int) -> int:
        text = self.text
        m = _ASSIGNS.match(text, p, self.end)
        before = text[p - 1] if p > self.begin else ""
        if not m or (text[p] == "=" and before in "=!<>~" and before) or (text[p] == ":" and before == ":"):
            return p + 1
        append = text[p] == "=" and before in ("+", ".") and not text[p - 2 : p - 1].isalnum()
        start = p - (before != "" and before in ("+.?|&:" if text[p] == "=" else "?"))
        name, begins = self._name_before(start)
        names = [name] if name else []
        if text[p] == "=":
            if name in ("string", "String"):  # the type may follow the name
                other = self._name_before(begins)[0]
                names += [other] if other else []
            if self.colon and _TYPE.fullmatch(text, self.colon[0], start):
                names += self.colon[1]
            if self.carried[0] == p:
                self.carried[1].extend(names)
                names = self.carried[1]
            self.colon, self.carried = None, (-1, [])
        if not names:
            return m.end()
        if text[p] == ":":
            self.colon = (p + 1, names)
        column = begins - self.line
        if m[0][0] == ":" and (block := _BLOCK.match(text, m.end(), self.end)):
            value, end = self._block(block.end(), self.indent)
            self._bind(names, value, False, begins)
            return end
        value, end = self._expression(m.end())
        if value is None:
            if (again := _AGAIN.match(text, m.end(), self.end)) and m[0][0] == "=":
                self.carried = (again.end() - 1, names)
            rest = text[m.end() : m.end() + 1]
            if rest in ("{", "["):
                self.pending = (names[0],) if rest == "{" else ()
            elif rest in ("", "\n", "\r") and text[p] == ":" and column >= 0:
                self._push("key", column, (names[0],))
            return m.end()
        if append and names[0] in self.known:
            value = self._kept(_joined([self.known[names[0]], value]))
        self._bind(names, value, bool(_DECLARES.search(text, max(self.begin, begins - EDGE), begins)), begins)
        return end

    def _bind(self, names: list[str], value: Value, declared: bool, at: int) -> None:
        self.pairs.append((names, self._enclosing(), value))
        for n in names:
            old = self.known.get(n)
            if self.scopes and (declared or old is None or (self.frames and any(f.kind == "indent" for f in self.frames[-2:]))):
                self.scopes[-1].append((n, old))
            self.known[n] = value

    def _kept(self, value: Value) -> Value:
        """Values in order of making: parts come before what they make."""
        self.values.append(value)
        return value

    def _block(self, at: int, indent: int) -> tuple[Value, int]:
        """The lines that are indented deeper, as values of their own."""
        lines = []
        while at < self.end:
            end = self.text.find("\n", at, self.end)
            end = self.end if end < 0 else end
            line = self.text[at:end]
            if line.strip():
                if len(line) - len(line.lstrip(" \t")) <= indent:
                    break
                lines.append((at, end))
            at = end + 1
        return self._lines(lines), min(max(at - 1, self.begin), self.end)

    def _lines(self, spans: list[tuple[int, int]]) -> Value:
        out = []
        for s, e in spans:
            line = self.text[s:e]
            s, e = s + len(line) - len(line.lstrip()), e - len(line) + len(line.rstrip())
            if s < e:
                out.append(self._kept(literal_value(self.text, s, e)))
        if len(out) == 1:
            return out[0]
        return self._kept(Value(sum(p.n for p in out), parts=tuple(out), separate=True))

    def _constant_later(self, at: int) -> bool:
        """Whether a concatenation that begins with a part of unknown value has a string or a known constant further on."""
        while (m := _OPERAND.match(self.text, at, self.end)) and (plus := _JOIN.match(self.text, m.end(), self.end)):
            at = plus.end()
            if _QUOTE.match(self.text, at, self.end) or ((m := _NAME.match(self.text, at, self.end)) and self._constant(m[0])):
                return True
        return False

    def _constant(self, name: str) -> Value | None:
        value = self.known.get(name)
        return value if value is not None and value.constant else None

    def _expression(self, begin: int) -> tuple[Value | None, int]:
        """Value of the expression at `begin`, None if nothing in it is constant, and where scanning goes on.

        Parts of unknown value add nothing; an expression that has some is scanned again, as they may hold assignments.
        """
        text, at, depth = self.text, begin, 0
        parts: list[Value] = []
        whole = True
        while True:
            while text[at : at + 1] == "(":
                depth, at = depth + 1, _GAP.match(text, at + 1, self.end).end()
            was_string = False
            if found := self._quoted(at):
                s, e, at = found
                was_string = True
                self._inside(s, e)
                if text.find("\n", s, e) >= 0:
                    parts.append(self._lines(self._split(s, e)))
                else:
                    used = [v for x in _INSERT.finditer(text, s, e) if (v := self._constant(x[1]))]
                    used += [v for x in _REFERENCE.finditer(text, s, e) if (v := self.known.get(x[1] or x[2])) and v not in used]
                    plain = _REFERENCE.sub("", _INSERT.sub("", text[s:e])) if used else text[s:e]
                    parts += used
                    parts.append(self._kept(Value(len(plain), Counter(plain), plain[:EDGE], plain[-EDGE:], (), (s, e))))
            elif (m := _REFERENCE.match(text, at, self.end)) and (v := self.known.get(m[1] or m[2])) is not None:
                parts.append(v)
                at = m.end()
            elif (m := _NAME.match(text, at, self.end)) and (v := self._constant(m[0])) is not None and text[m.end() : m.end() + 1] != "(":
                parts.append(v)
                at = m.end()
            elif not parts and whole and not depth and _AGAIN.match(text, at, self.end):
                return None, begin
            elif not parts and whole and not depth and not self._constant_later(at) and (end := self._bare_end(at)) > at:
                return self._bare(at, end), begin
            elif m := _OPERAND.match(text, at, self.end):
                at, whole = m.end(), False
            else:
                break
            if depth:
                at = _GAP.match(text, at, self.end).end()
                while depth and text[at : at + 1] == ")":
                    depth, at = depth - 1, at + 1
            if (was_string and (m := _NEXT_TO.match(text, at, self.end))) or (m := _JOIN.match(text, at, self.end)):
                at = _GAP.match(text, m.end(), self.end).end() if depth else m.end()
            elif not (depth and was_string and _QUOTE.match(text, at, self.end)):
                break
        if not parts:
            return None, begin
        value = _joined(parts)
        return value if len(parts) == 1 else self._kept(value), at if whole else begin

    def _bare_end(self, at: int) -> int:
        if self.run[0] <= at < self.run[1]:
            return self.run[1]
        m = _BARE.match(self.text, at, self.end)
        return m.end() if m else at

    def _bare(self, start: int, end: int) -> Value:
        """An unquoted value. Where values begin inside one another their characters are counted on from the one before."""
        at, stop, counts = self.run
        if stop == end and at <= start:
            counts = counts.copy()
            counts.subtract(self.text[at:start])
            counts = +counts
        else:
            counts = Counter(self.text[start:end])
        self.run = (start, end, counts)
        head, tail = self.text[start : min(end, start + EDGE)], self.text[max(start, end - EDGE) : end]
        return self._kept(Value(end - start, counts, head, tail, (), (start, end), False, False))

    def _split(self, start: int, end: int) -> list[tuple[int, int]]:
        out = []
        while start < end:
            e = self.text.find("\n", start, end)
            e = end if e < 0 else e
            out.append((start, e))
            start = e + 1
        return out
