"""The driver's tables seen as the engine's: documents as notices, orders as list items, events as fetch outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.schemas import NOTICE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(text: str) -> Column:
    return F.to_timestamp(F.lit(text))


def as_notices(rows: DataFrame) -> DataFrame:
    """Rows with some of a notice's columns as whole notices; what they lack is null."""
    return rows.select(*((F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in NOTICE))


def document_state(docs: DataFrame) -> DataFrame:
    """Nine of ten documents as stored notices: every seventh title differs, every eleventh date, every thirteenth was never hashed."""
    i = F.col("doc_id")
    rows = docs.where(i % 10 != 0).select(
        F.col("source").alias("sourceId"), i.alias("articleNo"), F.when(i % 7 == 0, F.concat(F.lit("old "), F.left("text", F.lit(40)))).otherwise(F.left("text", F.lit(40))).alias("title"),
        F.when(i % 11 == 0, F.lit("2026-03-20")).otherwise(F.lit("2026-04-01")).alias("date"), F.lit("").alias("category"), F.lit("").alias("author"), F.lit("d").alias("department"),
        F.col("n_chars").alias("views"), F.col("text").alias("content"), F.col("text").alias("contentText"), F.col("text").alias("cleanHtml"), F.col("text").alias("cleanMarkdown"),
        F.array().cast("array<struct<name:string,url:string,referer:string>>").alias("attachments"), F.lit("u").alias("sourceUrl"), F.lit("p").alias("detailPath"),
        F.when(i % 13 == 0, None).otherwise(F.sha2("text", 256)).alias("contentHash"), F.array().alias("editHistory"), F.lit(0).alias("editCount"), F.lit(False).alias("isDeleted"),
        (i % 4).cast("int").alias("consecutiveFailures"), stamp("2026-03-21 00:00:00").alias("crawledAt"))
    return as_notices(rows)


def document_items(docs: DataFrame) -> DataFrame:
    """All documents as list items seen later; every seventeenth is dated before the floor."""
    i = F.col("doc_id")
    return docs.select(
        F.col("source").alias("sourceId"), i.alias("articleNo"), F.left("text", F.lit(40)).alias("title"), F.when(i % 17 == 0, F.lit("2026-01-01")).otherwise(F.lit("2026-04-01")).alias("date"),
        F.lit("").alias("category"), F.lit("").alias("author"), (F.col("n_chars") + 1).alias("views"), F.lit("p").alias("detailPath"), F.col("text"))


def event_outcomes(events: DataFrame) -> DataFrame:
    """Events as ordered fetch outcomes: an error is a missing page."""
    return events.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("failed"))


def page_attachments(pages: DataFrame) -> DataFrame:
    """Each page as a notice with three attachments, faulty in ways that its number decides."""
    i = F.col("page_id")
    url = F.when(i % 6 == 1, F.lit("")).when(i % 6 == 2, F.lit("#")).when(i % 6 == 3, F.concat(F.lit("ftp://x/"), i.cast("string"))).otherwise(F.col("url"))
    name = F.when(i % 5 == 1, F.lit(" ")).when(i % 5 == 2, F.lit("Unknown")).when(i % 5 == 3, F.col("url")).otherwise(F.lit("file.pdf"))
    att = lambda n, u, r: F.struct(n.alias("name"), u.alias("url"), r.alias("referer"))
    none = F.lit(None).cast("string")
    return pages.select(
        F.when(i % 2 == 0, F.lit("board")).otherwise(F.lit("other")).alias("sourceId"), i.alias("articleNo"),
        F.array(att(name, url, none), att(F.lit("b"), F.col("url"), F.col("url")), att(F.lit("c"), F.when(i % 4 == 0, F.col("url")).otherwise(F.lit("https://c.example.com/x")), none)).alias("attachments"))
