"""Sanitised HTML from raw notice pages: a fixed sequence of rules over a column of numbered markup."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions import marks
from tidings.functions.marks import ANY, BLANK, DECLARED, DIGITS, END, GT, LT, NOTED, NUMBER, OF, TEXT_QUOTE, VOIDS, attribute, declared, drop, let, noted, tag, until_same, where_held, whole, word_of

# Fixed values.
REMOVED = "script style iframe form button tfoot title head".split()
REMOVED_VOID = "input meta link".split()
REMOVED_CLASSES = "board-view-title-wrap board-view-file-wrap board-view-nav".split()
REMOVED_DIV, REMOVED_LINK = "w3eden", "mode=list"
INLINE = "span a font b i em strong mark".split()
ALLOWED_TAGS = "p br div span h1 h2 h3 h4 strong b em i mark ul ol li table thead tbody tr th td img a hr".split()
ALLOWED_ATTRS = {"a": ["href"], "img": ["src", "alt", "width", "height"], "td": ["colspan", "rowspan"], "th": ["colspan", "rowspan"]}
ALLOWED_STYLES = "color background-color text-align text-decoration font-weight font-style".split()
ALLOWED_SCHEMES = "http https mailto tel data".split()
REMOVABLE = "p span div strong b em i mark h1 h2 h3 h4 a li td th tr thead tbody table ul ol".split()
LAYOUT_TABLE = "__se_tbl_ext"
DATA_IMAGE_LEAST = 1024  # bytes
CJK_PUNCTUATION = "（）［］【】「」『』〈〉《》〔〕、，。：；！？·～—–"

_ONE_OF = "|".join
_PUNCTUATION = "".join(f"\\u{ord(c):04x}" for c in string.whitespace + string.punctuation + string.digits + CJK_PUNCTUATION + LT + GT + TEXT_QUOTE)
_EMPHASIS = "strong|b|em|i"
_CODED = -(-DATA_IMAGE_LEAST * 4 // 3) - 1  # the most letters of base64 that give fewer bytes
_BOLD, _BREAK, _FROM, _TO = "\ufdde\ufddc\ufdda\ufddb"


def numbers_of(names: str, numbers: Column, end: str = "/?") -> Column:
    """A pattern for the tags of these elements with one of the numbers."""
    return F.concat(F.lit(f"<{end}(?:{names}){NUMBER}(?:"), F.array_join(numbers, "|"), F.lit(f")(?![{DIGITS}])[^>]*>"))


def drop_subtrees(x: Column) -> Column:
    classes = word_of("class", _ONE_OF(REMOVED_CLASSES))
    x = drop(x, tag(_ONE_OF(REMOVED_VOID)), whole(_ONE_OF(REMOVED)), tag(VOIDS, classes), whole(ANY, classes))
    x = where_held(x, REMOVED_LINK, lambda s: drop(s, whole("a", attribute("href", f'[^"]*{REMOVED_LINK}[^"]*'))))
    return where_held(x, REMOVED_DIV, lambda s: drop(s, whole("div", word_of("class", REMOVED_DIV))))


def drop_small_data_images(x: Column) -> Column:
    """Inline images without data or of fewer decoded bytes than a real picture has."""
    return where_held(x, "data:", lambda s: drop(s, tag("img", attribute("src", f'[{BLANK}]*data:(?:[^",]*|[^",]*,[^"]{{0,{_CODED}}}?[{BLANK}]*)'))))


def unwrap_layout_tables(x: Column) -> Column:
    """What the cells hold, without the table and what stands between its cells."""
    layout = f'(?:[^"]*[{BLANK}])?{LAYOUT_TABLE}(?:[{BLANK}][^"]*)?'
    held = f"{NUMBER}(?=[^>]*{noted('in', layout)})[^>]*>"
    return where_held(x, LAYOUT_TABLE, lambda s: drop(s, whole("table", noted("outside", layout)), f"<(?!/table{NUMBER}|t[dh]{NUMBER})/?+{ANY}{held}[^<]*", f"<(?:/table|t[dh]){held}"))


def split_pre(x: Column) -> Column:
    """A preformatted block as paragraphs: one for each stretch between blank lines, breaks inside. Childless elements stay."""
    childless = f"<(?!(?:br|pre){NUMBER})(?:(?:{VOIDS}){NUMBER}[^>]*>|({ANY}){NUMBER}([{DIGITS}]++)[^>]*></\\1{NUMBER}\\2(?![{DIGITS}])[^>]*>)"

    def paragraphs(pre: Column) -> Column:
        number = F.regexp_extract(pre, f"^<pre{NUMBER}([{DIGITS}]+)", 1)
        text = drop(F.replace(drop(pre, "<[^>]*>"), F.lit("\r\n"), F.lit("\n")), "^\n+|\n+$")
        blocks = F.filter(F.split(text, f"\n[{BLANK}]*\n"), lambda b: b.rlike(f"[^{BLANK}]"))
        lines = lambda b: F.replace(b, F.lit("\n"), F.concat(F.lit(f"<br{NUMBER}"), number, F.lit(">")))
        made = F.transform(blocks, lambda b: F.concat(F.lit(f"<p{NUMBER}"), number, F.lit(">"), lines(b), F.lit(f"</p{NUMBER}"), number, F.lit(">")))
        return F.array_join(F.concat(made, F.regexp_extract_all(pre, F.lit(childless), F.lit(0))), "")

    parted = F.regexp_replace(x, whole("pre"), f"{_FROM}$0{_FROM}")
    return F.array_join(F.transform(F.split(parted, _FROM), lambda p: F.when(p.startswith(f"<pre{NUMBER}"), paragraphs(p)).otherwise(p)), "")


def styles_to_tags(x: Column) -> Column:
    """Bold and italic given by the style of inline elements become elements inside them."""

    def made_tags(x: Column) -> Column:
        for name, value, made, same in (("font-weight", r"(?:bold|bolder|0*[6-9]\d\d|0*[1-9]\d{3,})", "strong", ("strong", "b")), ("font-style", "italic", "em", ("em", "i"))):
            held = f"(?i:{declared(name, value)})"
            for end, put in (("", f"$1<{made}{NUMBER}$2>"), ("/", f"</{made}{NUMBER}$2>$1")):
                x = F.regexp_replace(x, f"(<{end}(?:{_ONE_OF(t for t in INLINE if t not in same)}){NUMBER}([{DIGITS}]++)(?=[^>]*{held})[^>]*>)", put)
            x = drop(x, f"(?i){DECLARED}(?:{_ONE_OF(INLINE)}){OF}{name}:{value}{END}")
        return x

    return where_held(x, DECLARED, made_tags)


def unwrap_underlined_emphasis(x: Column) -> Column:
    return where_held(x, DECLARED, lambda s: drop(s, tag("em|i", f"(?i:{declared('text-decoration', f'[^>{END}]*underline[^>{END}]*')})", "/?")))


def sanitise(x: Column) -> Column:
    """Only allowed elements, attributes, style properties and URL schemes are left; other elements give way to their content."""
    kept = _ONE_OF(f"{t}{OF}{a}" for t, names in ALLOWED_ATTRS.items() for a in names)
    x = drop(x, f"</?+(?!(?:{_ONE_OF(ALLOWED_TAGS)}){NUMBER})[^>]*>", f' (?!(?:{kept})=)[^\\s{OF}"]*{OF}[^\\s"]+="[^"]*"')
    x = drop(x, f' (?:a{OF}href|img{OF}src)="[^"]*"(?=[^>]*{noted("scheme", f"(?!(?:{_ONE_OF(ALLOWED_SCHEMES)}){chr(34)})[^{chr(34)}]*")})')
    x = where_held(x, DECLARED, lambda s: drop(s, f"{DECLARED}[^{OF}]*{OF}(?!(?:{_ONE_OF(ALLOWED_STYLES)}):)[^{END}]*{END}"))
    return drop(x, f' {NOTED}[^"]*="[^"]*"')


def drop_empty(x: Column, passes: int = 10) -> Column:
    """Elements with neither text nor an element in them go, and then those that this empties."""
    return until_same(x, lambda s: drop(s, f"<({_ONE_OF(REMOVABLE)}){NUMBER}[^>]*>[{BLANK}]*</\\1{NUMBER}[^>]*>"), passes)


def unwrap_bare_spans(x: Column) -> Column:
    return drop(x, f"</?span{NUMBER}[{DIGITS}]*>")


def collapse_divs(x: Column) -> Column:
    """A div that holds nothing but another div becomes that div: their opening tags stand side by side, and their closing ones."""
    opened, closed = (f"<{end}div{NUMBER}([{DIGITS}]++)[^>]*>[{BLANK}]*(?=<{end}div{NUMBER}([{DIGITS}]++))" for end in ("", "/"))

    def collapsed(s: Column) -> Column:
        all_ = lambda p, k: F.regexp_extract_all(s, F.lit(p), F.lit(k))
        outer_first = F.zip_with(all_(opened, 1), all_(opened, 2), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        inner_first = F.zip_with(all_(closed, 1), all_(closed, 2), lambda b, a: F.struct(a.alias("a"), b.alias("b")))
        return let(F.array_intersect(outer_first, inner_first)["a"], lambda outer: F.when(F.size(outer) == 0, s).otherwise(without(s, outer)))

    def without(s: Column, outer: Column) -> Column:
        s = F.regexp_replace(s, F.concat(numbers_of("div", outer, ""), F.lit(f"[{BLANK}]*")), F.lit(""))
        return F.regexp_replace(s, F.concat(F.lit(f"[{BLANK}]*"), numbers_of("div", outer, "/")), F.lit(""))

    return let(x, collapsed)


def unwrap_punctuation(x: Column) -> Column:
    return F.regexp_replace(x, f"<({_EMPHASIS}){NUMBER}[^>]*>(?![{BLANK}]*[0-9]+[{BLANK}]*<)([{_PUNCTUATION}]+)</\\1{NUMBER}[^>]*>", "$2")


def unwrap_bold_runs(x: Column, least: int = 3) -> Column:
    """Where whole blocks in a row are bold, bold says nothing: it goes. Blocks inside bold don't count."""

    def unwrapped(s: Column) -> Column:
        # Bold elements by their numbers alone, then blocks of nothing else by what they hold, then blocks side by side as one.
        t = F.regexp_replace(F.regexp_replace(s, whole("strong|b"), f"{_BOLD}$2"), tag("br"), _BREAK)
        inside = f"[{_BREAK}{BLANK}]*{_BOLD}[{_BOLD}{_BREAK}{DIGITS}{BLANK}]*"
        t = F.regexp_replace(t, f"<(p|div){NUMBER}([{DIGITS}]++)[^>]*>({inside})</\\1{NUMBER}\\2(?![{DIGITS}])[^>]*>", f"{_FROM}$3{_TO}")
        runs = F.regexp_extract_all(F.regexp_replace(t, f"{_TO}[{BLANK}]*{_FROM}", ","), F.lit(f"{_FROM}([^{_TO}]*){_TO}"), F.lit(1))
        long = F.filter(runs, lambda r: F.size(F.split(r, ",")) >= least)
        bold = F.regexp_extract_all(F.array_join(long, ""), F.lit(f"{_BOLD}([{DIGITS}]+)"), F.lit(1))
        return let(bold, lambda b: F.when(F.size(b) == 0, s).otherwise(F.regexp_replace(s, numbers_of("strong|b", b), F.lit(""))))

    return let(x, unwrapped)


def merge_emphasis(x: Column, passes: int = 10) -> Column:
    """Neighbours of the same emphasis, with at most one blank text between, become one."""
    return until_same(x, lambda s: F.regexp_replace(s, f"</({_EMPHASIS}){NUMBER}[^>]*>([{BLANK}]*)<\\1{NUMBER}[^>]*>", "$2"), passes)


RULES = (
    drop_subtrees, drop_small_data_images, unwrap_layout_tables, split_pre, styles_to_tags, unwrap_underlined_emphasis, marks.absolute, sanitise,
    drop_empty, unwrap_bare_spans, collapse_divs, drop_small_data_images, unwrap_punctuation, unwrap_bold_runs, merge_emphasis,
)


def clean_html(raw: Column, base: Column) -> Column:
    """Sanitised HTML of a page or fragment; null for null, blank or emptied input, and for input that can't be handled."""
    return clean_numbered(marks.numbered_body_udf(raw, base))


def clean_numbered(body: Column) -> Column:
    """The same of a page's numbered body."""
    out = marks.to_html(reduce(lambda s, rule: rule(s), RULES, body))
    return let(drop(out, f"^[{BLANK}]+|[{BLANK}]+$"), lambda html: F.when(html != "", html))


def normalize_content_urls(raw: Column, base: Column) -> Column:
    """Only image and link addresses made absolute; null and '' stay; input that can't be handled stays as it is."""
    return F.when(raw == "", raw).otherwise(F.coalesce(marks.as_written(marks.absolute(marks.numbered_udf(raw, base))), raw))
