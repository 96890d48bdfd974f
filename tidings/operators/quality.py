"""Checks of attachments and Markdown, and their reports."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.textify import ustrip
from tidings.functions.urls import host, host_allowed
from tidings.schemas import ATTACHMENT_ISSUE, MARKDOWN_ISSUE

NEEDS_REFERER = ("gnuboard", "gnuboard-custom")


def _issue(check: str, i: Column, text: Column, a: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), i.cast("int").alias("attachment_index"), text.alias("detail"), a["url"].alias("url"), a["name"].alias("name"))


def attachment_issues(attachments: Column, strategy: Column, suffixes: list[str], strict_hosts: bool = False) -> Column:
    """Issues of a notice's attachments as an array: five checks for each, then repeated addresses."""
    blank = lambda x: x.isNull() | (ustrip(x) == "")
    web = lambda u: u.startswith("http://") | u.startswith("https://")
    text = lambda x: F.coalesce(x, F.lit(""))

    def of_one(a: Column, i: Column) -> Column:
        url, name = text(a["url"]), text(a["name"])
        scheme = (
            F.when(blank(url), F.lit("empty URL")).when(ustrip(url) == "#", F.lit("anchor-only URL '#'"))
            .when(~web(url), F.concat(F.lit("URL does not start with http(s)://: "), F.left(url, F.lit(80))))
        )
        named = F.when(blank(name), F.lit("empty attachment name")).when(F.lower(ustrip(name)) == "unknown", F.lit("name is 'unknown'"))
        is_url = F.when(web(name), F.lit("name is a URL (likely extraction bug)"))
        referer = F.when(strategy.isin(*NEEDS_REFERER) & blank(a["referer"]), F.lit("gnuboard attachment missing referer field"))
        h = F.coalesce(host(url), F.lit(""))
        hosted = F.when(web(url) & ~host_allowed(url, suffixes, strict_hosts), F.concat(F.lit("host '"), h, F.lit("' not in allowed list")))
        found = F.array(*(F.when(d.isNotNull(), _issue(c, i, d, a)) for c, d in (
            ("invalid_scheme", scheme), ("blank_name", named), ("name_is_url", is_url), ("missing_referer", referer), ("disallowed_host", hosted))))
        return F.filter(found, lambda x: x.isNotNull())

    urls = F.transform(attachments, lambda a: text(a["url"]))

    def repeated(a: Column, i: Column) -> Column:
        first = F.array_position(urls, text(a["url"])) - 1
        return F.when((text(a["url"]) != "") & (first < i), _issue("duplicate_url", i, F.concat(F.lit("same URL as attachment["), first.cast("string"), F.lit("]")), a))

    each = F.flatten(F.transform(attachments, of_one))
    again = F.filter(F.transform(attachments, repeated), lambda x: x.isNotNull())
    return F.concat(each, again).cast(T.ArrayType(ATTACHMENT_ISSUE))


def check_attachments(notices: DataFrame, sources: DataFrame, suffixes: list[str], *, wanted: list[str] | None = None, strict_hosts: bool = False, limit: int | None = None) -> DataFrame:
    """Notices with attachments and their `issues`; the strategy comes from the catalogue and may be unknown. `limit`: so many notices at most, by key."""
    known = sources.select(F.col("id").alias("_id"), F.col("strategy").alias("strategy"))
    some = notices.where(F.col("attachments").isNotNull() & (F.size("attachments") > 0))
    some = some.where(F.col("sourceId").isin(wanted)) if wanted else some
    some = some.orderBy("sourceId", "articleNo").limit(limit) if limit else some
    joined = some.join(known, F.col("sourceId") == F.col("_id"), "left").drop("_id")
    return joined.withColumn("issues", attachment_issues(F.col("attachments"), F.col("strategy"), suffixes, strict_hosts))


def with_reachability(checked: DataFrame, answers: DataFrame) -> DataFrame:
    """Adds an issue for each attachment whose address answered with an error or not at all (url, status).

    Boards that demand a referer are not asked; addresses that nobody tried have no issue.
    """
    each = checked.where(~F.coalesce(F.col("strategy").isin(*NEEDS_REFERER), F.lit(False))).select("sourceId", "articleNo", F.posexplode("attachments").alias("i", "a"))
    bad = each.join(answers.select(F.col("url").alias("_u"), "status"), F.col("a.url") == F.col("_u")).where((F.col("status") >= 400) | (F.col("status") == 0))
    text = F.when(F.col("status") == 0, F.lit("no answer")).otherwise(F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    found = bad.withColumn("x", _issue("unreachable", F.col("i"), text, F.col("a"))).groupBy("sourceId", "articleNo").agg(F.sort_array(F.collect_list("x")).alias("_more"))
    joined = checked.join(found, ["sourceId", "articleNo"], "left")
    return joined.withColumn("issues", F.concat("issues", F.coalesce("_more", F.array().cast(T.ArrayType(ATTACHMENT_ISSUE))))).drop("_more")


def issue_counts(checked: DataFrame) -> DataFrame:
    """How often each check failed, by name."""
    return checked.select(F.explode("issues").alias("x")).groupBy(F.col("x.check").alias("check")).agg(F.count(F.lit(1)).alias("n")).orderBy("check")


def report(checked: DataFrame) -> DataFrame:
    """Notices, attachments if there are any, notices with issues, and issues, as one row."""
    attachments = F.coalesce(F.sum(F.size("attachments")), F.lit(0)) if "attachments" in checked.columns else F.lit(0)
    return checked.agg(F.count(F.lit(1)).alias("notices"), attachments.alias("attachments"), F.count_if(F.size("issues") > 0).alias("withIssues"), F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("issues"))


def json_report(checked: DataFrame, key: tuple[str, ...] = ("sourceId", "articleNo")) -> DataFrame:
    """One JSON object for each notice with issues (`text`), by key."""
    bad = checked.where(F.size("issues") > 0)
    return bad.select(*key, F.to_json(F.struct(*key, "issues"), {"ignoreNullFields": "false"}).alias("text"))


def addresses(checked: DataFrame) -> DataFrame:
    """The different web addresses of attachments whose boards ask for no referer: what a reachability check requests."""
    asked = checked.where(~F.coalesce(F.col("strategy").isin(*NEEDS_REFERER), F.lit(False)))
    return asked.select(F.explode("attachments").alias("a")).select(F.col("a.url").alias("url")).where(F.col("url").rlike("^https?://")).distinct()


# Markdown

# The texts of the issues, here and above, which reports show.

# The patterns of the checks.
CROSS_LINE = re.compile(r"\*\*(\S(?:[^*\n]|\*(?!\*))*?)\n((?:[^*]|\*(?!\*))*?\S)\*\*")
SPACE_BEFORE_CLOSE = re.compile(r"\*\*\S[^*\n]*[ \t]\*\*")
EMPTY_HEADER = re.compile(r"^(\|[ \t]*)+\|[ \t]*\n(\|[ \t]*-[-\s]*)+\|", re.MULTILINE)
BROKEN_LINK = re.compile(r"!?\[[^\]]*\]\([^\)\n]*$", re.MULTILINE)


def _opens(md: str, at: int) -> bool:
    """Can the stars here open a bold run? Only at the start or after a space."""
    return at == 0 or md[at - 1] in " \t\n"


def _cross_line(md: str) -> list[tuple]:
    return [(m, f"Strong emphasis spans {m[0].count(chr(10))} line(s)") for m in CROSS_LINE.finditer(md) if "**" not in m[1] and "**" not in m[2] and _opens(md, m.start())]


def _space_before_close(md: str) -> list[tuple]:
    return [(m, "Space before closing ** breaks bold in CommonMark") for m in SPACE_BEFORE_CLOSE.finditer(md) if _opens(md, m.start())]


def _empty_header(md: str) -> list[tuple]:
    return [(m, "Table header row has all-empty cells") for m in EMPTY_HEADER.finditer(md)]


def _broken_link(md: str) -> list[tuple]:
    return [(m, "Unclosed parenthesis in link/image") for m in BROKEN_LINK.finditer(md)]


#: The checks in order: name, severity, finder. More can be added.
MARKDOWN_CHECKS: list[tuple[str, str, Callable[[str], list[tuple]]]] = [
    ("cross_line_strong", "warning", _cross_line), ("space_before_close_emphasis", "error", _space_before_close),
    ("empty_table_header", "warning", _empty_header), ("broken_link", "error", _broken_link),
]


def markdown_issues(md: str | None, min_severity: str = "warning") -> list[dict]:
    """Issues of a text by check, then place; only `error` as the least severity leaves any out."""
    md = (md or "").replace("\r\n", "\n")
    out = []
    for check, severity, find in MARKDOWN_CHECKS:
        if min_severity == "error" and severity != "error":
            continue
        for m, text in find(md):
            cut = m[0] if len(m[0]) <= 120 else m[0][:120] + "..."
            out.append({"check": check, "line": md.count("\n", 0, m.start()) + 1, "detail": text, "snippet": cut, "severity": severity})
    return out


def check_markdown(notices: DataFrame, column: str = "cleanMarkdown", min_severity: str = "warning") -> DataFrame:
    """Notices that have Markdown, with their `issues`. Texts without a star, bar or bracket never reach Python."""

    @F.pandas_udf(T.ArrayType(MARKDOWN_ISSUE))
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([markdown_issues(t, min_severity) for t in texts], dtype=object)

    none = F.array().cast(T.ArrayType(MARKDOWN_ISSUE))
    suspect = F.col(column).contains("**") | F.col(column).contains("](") | F.col(column).contains("|")
    return notices.where(F.col(column).isNotNull()).withColumn("issues", F.coalesce(found(F.when(suspect, F.col(column))), none))


def markdown_counts(checked: DataFrame) -> DataFrame:
    """How often each check failed, most first."""
    return checked.select(F.explode("issues").alias("x")).groupBy(F.col("x.check").alias("check")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "check")
