"""Notices from list items and details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.textify import with_representations
from tidings.functions.urls import source_url_expr
from tidings.session import small


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the name (`_name`) and address (`_base`) of their source; a small catalogue is broadcast, once counted."""
    known = sources.select(F.col("id").alias("_id"), F.col("name").alias("_name"), F.col("baseUrl").alias("_base"))
    return rows.join(small(known), F.col("sourceId") == F.col("_id"), "left").drop("_id")


def build_notices(joined: DataFrame, sources: DataFrame) -> DataFrame:
    """Notices of classified items with their `detail` (may be null) and `crawledAt`.

    The detail's title, if it has one, wins. Links resolve against the board's address. Pages beyond the size limit have
    neither content nor clean HTML nor Markdown. Text is that of the clean HTML; without clean HTML it falls back to what the
    page reader found, then to null. `imageSizes` (url, w, h), if there, fills in what images lack; the hash is that of the
    clean HTML before, here and in the update check alike.
    """
    d = F.col("detail")
    base = with_source(joined, sources).withColumn(
        "sourceUrl", source_url_expr(F.coalesce("_base", F.lit("")), F.coalesce("detailPath", F.lit(""))))
    made = with_representations(base, F.when(d["content"] != "", d["content"]), F.col("_base"), sizes=F.col("imageSizes") if "imageSizes" in joined.columns else None)
    r = F.col("_r")
    text = F.when(r["cleanHtml"].isNotNull(), r["contentText"]).otherwise(F.nullif(d["contentText"], F.lit("")))
    return made.select(
        "articleNo", "sourceId", F.coalesce(F.when(d["title"] != "", d["title"]), F.col("title")).alias("title"), "category", "author",
        F.coalesce("_name", F.lit("")).alias("department"), "date", F.coalesce("views", F.lit(0)).alias("views"), r["content"].alias("content"),
        text.alias("contentText"), r["cleanHtml"].alias("cleanHtml"), r["cleanMarkdown"].alias("cleanMarkdown"),
        F.coalesce(d["attachments"], F.array().cast("array<struct<name:string,url:string,referer:string>>")).alias("attachments"),
        "sourceUrl", "detailPath", "crawledAt", F.lit(None).cast("string").alias("lastModified"), r["contentHash"].alias("contentHash"))
