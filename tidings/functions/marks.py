"""Numbered markup: pages as balanced tags that columns can work on.

Python only repairs a page's markup and writes its tags (`numbered`): every tag carries its element's number, a closing tag
repeats the attributes of the opening one, attributes are named with their element, declarations of a style stand one by
one, and a few facts that need the tree are noted (an address made absolute and its scheme, the classes of the nearest
table of what is in none of its cells, breaks inside cells). Signs that would be markup inside texts and values are written as noncharacters. So every
rule on elements is a regular expression over a column: an element is unwrapped by deleting its two tags, dropped from its
tag to the one of the same number, and what follows what is seen from tags side by side.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.dom import VOID, Element, Text, body_of, parse
from tidings.functions.urls import resolve_url

# In texts and values: < > " ' of values, " of texts, and < > & that stay as they are (scripts).
LT, GT, QUOTE, APOSTROPHE, TEXT_QUOTE, RAW_LT, RAW_GT, RAW_AND = "\ufdd0\ufdd1\ufdd2\ufdd3\ufdd4\ufdea\ufdeb\ufdec"
# In tags: between element and attribute, before the number, around a declaration, before a noted fact.
OF, NUMBER, DECLARED, END, NOTED = "\ufdd5\ufdd6\ufdd7\ufdd8\ufdd9"
DIGITS = "\ufde0-\ufde9"
#: What Python strips, and the space that doesn't break, as the inside of a class of characters.
BLANK = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
VOIDS = "|".join(sorted(VOID))

SCHEME = re.compile(r"\s*([A-Za-z][A-Za-z0-9+.-]*):")
UNSEEN = re.compile(r"[\x00-\x1f\x7f-\x9f\u200b-\u200f\u2028-\u202e\u2060\ufeff]+")  # what browsers pass over in an address, and more
_FOREIGN = re.compile("[\ufdd0-\ufdef]")
_VALUE = str.maketrans({"<": LT, ">": GT, '"': QUOTE, "'": APOSTROPHE})
_TEXT = str.maketrans({"<": LT, ">": GT, '"': TEXT_QUOTE})
_RAW = str.maketrans({"<": RAW_LT, ">": RAW_GT, "&": RAW_AND, '"': TEXT_QUOTE})
_COUNT = str.maketrans({str(k): chr(0xFDE0 + k) for k in range(10)})


def declarations(style: str) -> dict[str, str]:
    """The declarations of a style attribute, names lower-case, in order."""
    out = {}
    for part in style.split(";"):
        name, colon, value = part.partition(":")
        if colon and name.strip():
            out[name.strip().lower()] = value.strip()
    return out


def _facts(e: Element, base: str | None, table: str | None, in_cell: bool, loose: bool) -> dict[str, str]:
    out = {}
    address = e.attr("src") if e.tag == "img" else e.attr("href") if e.tag == "a" else ""
    if address:
        resolved = resolve_url(address, base)
        if resolved != address:
            out["at"] = resolved
        scheme = SCHEME.match(UNSEEN.sub("", resolved[:1000]))
        if scheme:
            out["scheme"] = scheme[1].lower()
    if e.tag == "table":
        out["in"] = e.attr("class")
        if loose:
            out["outside"] = table
    elif loose:
        out["in"] = table
    if e.tag == "br" and in_cell:
        out["cell"] = "1"
    return out


def numbered(html: str | None, base: str | None = None, body: bool = False) -> str | None:
    """Numbered markup of a page, or of its body without style attributes as they were written; null for null and for what can't be read."""
    if html is None:
        return None
    try:
        root = parse(_FOREIGN.sub("\ufffd", html))
        root = body_of(root) if body else root
    except (ValueError, RecursionError):
        return None
    out, n = [], 0
    # Nodes with the nearest table's classes, whether they are in a cell, in that table but in none of its cells, in a script.
    todo: list = [(c, None, False, False, False) for c in reversed(root.children)]
    while todo:
        x, table, in_cell, loose, raw = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, Text):
            out.append(x.value.translate(_RAW if raw else _TEXT))
        else:
            n += 1
            tag, number = x.tag.translate(_VALUE), str(n).translate(_COUNT)
            attrs = "".join(f' {tag}{OF}{k.translate(_VALUE)}="{(v or "").translate(_VALUE)}"' for k, v in x.attrs.items() if not (body and k == "style"))
            facts = "".join(f' {NOTED}{k}="{v.translate(_VALUE)}"' for k, v in _facts(x, base, table, in_cell, loose).items())
            style = "".join(f"{DECLARED}{tag}{OF}{k.translate(_VALUE)}:{v.translate(_VALUE)}{END}" for k, v in declarations(x.attr("style")).items())
            inside = f"{tag}{NUMBER}{number}{attrs}{facts}{style}>"
            out.append("<" + inside)
            if x.tag not in VOID:
                todo.append(("</" + inside, None, False, False, False))
                cell, script = x.tag in ("td", "th"), x.tag in ("script", "style")
                below = (x.attr("class"), in_cell, True) if x.tag == "table" else (table, in_cell or cell, loose and not cell)
                todo += [(c, *below, script) for c in reversed(x.children)]
    return "".join(out)


@F.pandas_udf(T.StringType())
def numbered_udf(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([numbered(h, b) for h, b in zip(html, base)], dtype=object)


@F.pandas_udf(T.StringType())
def numbered_body_udf(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([numbered(h, b, body=True) for h, b in zip(html, base)], dtype=object)


# Patterns


def tag(names: str, with_: str = "", end: str = "") -> str:
    """Opening tags of elements (`end`: '/' closing ones, '/?' both) that have something inside."""
    return f"<{end}(?:{names}){NUMBER}{f'(?=[^>]*{with_})' if with_ else ''}[^>]*>"


def whole(names: str, with_: str = "") -> str:
    """Elements from tag to tag, outermost first: groups 1 and 2 are the name and the number. No void ones."""
    return f"(?s)<({names}){NUMBER}([{DIGITS}]++){f'(?=[^>]*{with_})' if with_ else ''}[^>]*>(?>.*?</\\1{NUMBER}\\2(?![{DIGITS}])[^>]*>)"


ANY = f"[^\\s<>/{NUMBER}]+"


def attribute(name: str, value: str, of: str = f"[^\\s{OF}\"]*+") -> str:
    return f' {of}{OF}{name}="{value}"'


def noted(name: str, value: str) -> str:
    return f' {NOTED}{name}="{value}"'


def word_of(name: str, words: str) -> str:
    """An attribute that holds one of the words, as classes are held."""
    return attribute(name, f'(?:[^"]*[{BLANK}])?(?:{words})(?:[{BLANK}][^"]*)?')


def declared(name: str, value: str) -> str:
    return f"{DECLARED}[^>{OF}]*{OF}{name}:{value}{END}"


def drop(x: Column, *patterns: str) -> Column:
    for p in patterns:
        x = F.regexp_replace(x, p, "")
    return x


def rewritten(x: Column, signs: str, written: str) -> Column:
    """Signs as other ones, none of which is a sign itself: where there are none, this is a search and no work by character."""
    for sign, by in zip(signs, written):
        x = F.replace(x, F.lit(sign), F.lit(by))
    return x


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def where_held(x: Column, sign: str, body) -> Column:
    """`body(x)` for what holds the sign, which the rule needs; the rest stays."""
    return let(x, lambda s: F.when(F.contains(s, F.lit(sign)), body(s)).otherwise(s))


def until_same(x: Column, body, passes: int) -> Column:
    """`body` again and again, until it changes nothing, `passes` times at most."""
    first = F.struct(x.alias("now"), F.lit(None).cast("string").alias("before"))
    again = lambda a, _: F.when(a["now"] == a["before"], a).otherwise(F.struct(body(a["now"]).alias("now"), a["now"].alias("before")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(passes)), first, again, lambda a: a["now"])


def plain(x: Column) -> Column:
    """A text or value as it was."""
    return rewritten(x, LT + GT + QUOTE + APOSTROPHE + TEXT_QUOTE + RAW_LT + RAW_GT + RAW_AND, "<>\"'\"<>&")


def to_html(x: Column) -> Column:
    """Numbered markup as HTML: numbers, notes and the attributes of closing tags go, declarations become a style again."""
    x = F.regexp_replace(x, f"</([^<>{NUMBER}]*){NUMBER}[^>]*>", "</$1>")
    x = F.regexp_replace(x, f"<([^<>/{NUMBER}]*){NUMBER}[{DIGITS}]*", "<$1")
    x = where_held(x, NOTED, lambda s: drop(s, noted("[^\\s\"]*", '[^"]*')))
    x = where_held(x, DECLARED, lambda s: F.regexp_replace(s, f"{DECLARED}[^{OF}]*{OF}", DECLARED))
    x = F.replace(F.replace(x, F.lit(END + DECLARED), F.lit(";")), F.lit(DECLARED), F.lit(' style="'))
    x = where_held(F.replace(x, F.lit(END), F.lit('"')), OF, lambda s: F.regexp_replace(s, f" [^\\s{OF}\"]*+{OF}", " "))
    x = F.replace(x, F.lit("&"), F.lit("&amp;"))
    for sign, written in ((LT, "&lt;"), (GT, "&gt;"), (QUOTE, "&quot;"), (APOSTROPHE, "&#x27;")):
        x = F.replace(x, F.lit(sign), F.lit(written))
    return rewritten(x, TEXT_QUOTE + RAW_LT + RAW_GT + RAW_AND, '"<>&')


def absolute(x: Column) -> Column:
    """Addresses of images and links in their absolute form."""
    return where_held(x, f"{NOTED}at=", lambda s: F.regexp_replace(s, f'( (?:img{OF}src|a{OF}href)=")[^"]*("[^>]* {NOTED}at="([^"]*)")', "$1$3$2"))


def as_written(x: Column) -> Column:
    """HTML with the styles as they were."""
    return to_html(drop(x, f"{DECLARED}[^{END}]*{END}"))


def text_of(x: Column) -> Column:
    """Text with a newline after each block and break, a space after each cell and for breaks inside cells."""
    x = F.regexp_replace(x, f"{tag('br', noted('cell', '1'))}|{tag('t[dh]', end='/')}", " ")
    x = F.regexp_replace(x, f"{tag('br')}|{tag('tr|p|div|h[1-4]|li', end='/')}", "\n")
    return plain(drop(x, "<[^>]*>"))


def image_addresses(x: Column) -> Column:
    """Addresses of the images that have an absolute web address, in order, repeats included."""
    found = F.regexp_extract_all(x, F.lit(f'<img{NUMBER}[^>]* img{OF}src="(https?://[^"]*)"'), F.lit(1))
    return F.transform(found, plain)


def with_sizes(x: Column, sizes: Column) -> Column:
    """Width and height for images that have neither and whose size (url, w, h) is known; of several the last."""

    def sized(piece: Column) -> Column:
        src = plain(F.regexp_extract(piece, f'^<img{NUMBER}[^>]* img{OF}src="([^"]*)"', 1))
        known = F.try_element_at(F.filter(sizes, lambda s: s["url"] == src), F.lit(-1))
        put = F.concat(F.lit(f'$1 img{OF}width="'), known["w"].cast("string"), F.lit(f'" img{OF}height="'), known["h"].cast("string"), F.lit('"$2>'))
        bare = drop(piece, f' img{OF}(?:width|height)=""')
        has = piece.rlike(f'^<img{NUMBER}[^>]* img{OF}(?:width|height)="[^"]')
        return F.when(piece.startswith(f"<img{NUMBER}") & ~has & known.isNotNull(), F.regexp_replace(bare, F.lit(f"^(<img{NUMBER}[^>{NOTED}{DECLARED}]*?)((?: {NOTED}[^>]*)?(?:{DECLARED}[^>]*)?)>"), put)).otherwise(piece)

    return F.array_join(F.transform(F.split(x, f"(?=<img{NUMBER})"), sized), "")
