"""Plain text, hashes and all representations of a notice, as columns; Python repairs markup and renders Markdown."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions import marks
from tidings.functions.clean import clean_numbered, normalize_content_urls
from tidings.functions.markdown import html_to_markdown

LIMIT = 5 * 1024 * 1024  # bytes of clean HTML


@F.pandas_udf(T.StringType())
def html_to_markdown_udf(html: pd.Series) -> pd.Series:
    return pd.Series([html_to_markdown(h) for h in html], dtype=object)


def _numbered(html: Column) -> Column:
    return marks.numbered_udf(html, F.lit(None).cast("string"))


def text_from_html(html: Column) -> Column:
    """Text with a newline after each block and break, a space after each cell and for breaks inside cells; '' for null."""
    return text_from_numbered(_numbered(html))


def text_from_numbered(markup: Column) -> Column:
    return F.coalesce(squeeze_expr(marks.text_of(markup)), F.lit(""))


def inject_dimensions(html: Column, sizes: Column, markup: Column | None = None) -> Column:
    """Width and height for images that have neither and whose size is known. `sizes`: an array of (url, w, h); `markup`: the HTML numbered, if at hand."""
    changed = marks.as_written(marks.with_sizes(_numbered(html) if markup is None else markup, sizes))
    return F.when((html != "") & (F.coalesce(F.size(sizes), F.lit(0)) > 0), F.coalesce(changed, html)).otherwise(html)


def absolute_image_urls(html: Column) -> Column:
    """Addresses of the images that have an absolute web address, in order, repeats included; none for null."""
    return F.coalesce(marks.image_addresses(_numbered(html)), F.array().cast("array<string>"))


def set_apart(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """`rows` with a column that is worked out before what uses it.

    A later Python function would else be planned over the rules themselves, which are then worked out for each use, and
    which Spark can't take apart where a rule holds one lambda in another.
    """
    return rows.withColumn(name, F.explode(F.array(value)))


def with_representations(rows: DataFrame, content: Column, base: Column, name: str = "_r", sizes: Column | None = None) -> DataFrame:
    """`rows` with a struct: raw content with absolute URLs, clean HTML, its text, Markdown and hash; all null for pages beyond the limit.

    `sizes` of images are filled in in HTML and Markdown; the hash is that of the clean HTML before. Each step of Python that
    waits for another takes a worker a core, so there are no more than needed: the page, the clean page, Markdown of the sized one.
    """
    made = rows.withColumns({"_raw": normalize_content_urls(content, base), "_body": marks.numbered_body_udf(content, base)})
    made = set_apart(made, "_clean", clean_numbered(F.col("_body"))).withColumn("_marks", _numbered(F.col("_clean")))
    clean = shown = F.col("_clean")
    if sizes is not None:
        made = set_apart(made, "_shown", inject_dimensions(F.when(within_limit(clean), clean), sizes, F.col("_marks")))
        shown = F.col("_shown")
    text, md = F.when(clean.isNotNull(), text_from_numbered(F.col("_marks"))), html_to_markdown_udf(shown)
    fields = {"content": F.col("_raw"), "cleanHtml": shown, "contentText": text, "cleanMarkdown": md, "contentHash": content_hash_expr(clean)}
    return made.withColumn(name, F.struct(*(F.when(within_limit(clean), x).alias(n) for n, x in fields.items()))).drop("_raw", "_body", "_clean", "_marks", "_shown")


# Built-in forms


def content_hash_expr(html: Column) -> Column:
    return F.when(html.isNull() | (html == ""), None).otherwise(F.sha2(html, 256))


def ustrip(x: Column) -> Column:
    """Trimmed of every Unicode space."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def squeeze_expr(x: Column) -> Column:
    x = F.regexp_replace(x, r"(?U)[\s&&[^\n]]+", " ")
    x = F.regexp_replace(x, r"(?U)\n[\s&&[^\n]]+", "\n")
    return ustrip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def within_limit(html: Column) -> Column:
    return F.coalesce(F.octet_length(html), F.lit(0)) <= LIMIT


def first_number(x: Column) -> Column:
    """The first run of digits, 0 if there is none or it is too large."""
    return F.coalesce(F.regexp_extract(x, r"(\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def normalize_date_expr(x: Column, as_of: Column) -> Column:
    """`MM-DD` gets the year that makes it no later than this month, `YY-MM-DD` the century; others stay."""
    month = F.regexp_extract(x, r"^(\d{2})-\d{2}$", 1).try_cast("int")
    year = F.year(as_of) - F.when(month > F.month(as_of), 1).otherwise(0)
    return F.when(x.rlike(r"^\d{2}-\d{2}$"), F.concat(year.cast("string"), F.lit("-"), x)).when(x.rlike(r"^\d{2}-\d{2}-\d{2}$"), F.concat(F.lit("20"), x)).otherwise(x)
