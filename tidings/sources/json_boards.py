"""Lists of JSON boards decoded inside the plan: bodies become VARIANT, list entries rows, fields columns. No Python runs.

A body that isn't JSON, says that it failed, or has no list gives no rows; a field that is missing or of another kind is
null, or empty where a notice has no null there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.schemas import ATTACHMENTS

#: Named entities that titles hold; numbered ones are computed.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "hellip": "…", "middot": "·", "ndash": "–", "mdash": "—",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "copy": "©", "reg": "®", "trade": "™", "times": "×",
}
PIECE = r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[A-Za-z]{2,6};|[^&]+|&"


def unescape(text: Column) -> Column:
    """Text with its entities replaced, each once; unknown ones, and numbers of no character, stay as they are."""
    named = F.create_map(*(F.lit(x) for pair in ENTITIES.items() for x in pair))

    def one(piece: Column) -> Column:
        number = F.when(piece.rlike("^&#[0-9]"), F.substring(piece, 3, 20)).when(piece.rlike("^&#[xX]"), F.substring(piece, 4, 20))
        base = F.when(piece.rlike("^&#[0-9]"), 10).otherwise(16)
        digits = F.regexp_replace(number, ";$", "")
        code = F.when(base == 10, digits.cast("long")).otherwise(F.conv(digits, 16, 10).cast("long"))
        real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(real, F.decode(F.unhex(F.lpad(F.hex(F.when(real, code).otherwise(32)), 8, "0")), "UTF-32"))
        word = F.when(piece.rlike("^&[A-Za-z]"), F.try_element_at(named, F.substring_index(F.substring(piece, 2, 10), ";", 1)))
        return F.coalesce(char, word, piece)

    return F.when(text.contains("&"), F.array_join(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), one), "")).otherwise(text)


def _get(value: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _text(value: str, path: str) -> Column:
    return F.coalesce(_get(value, path), F.lit(""))


def _entries(pages: DataFrame, held: Column) -> DataFrame:
    """A row for each entry of each page's list (`_value`), with its place (`pos`)."""
    spark = pages.sparkSession
    listed = pages.withColumn("_list", held)
    each = listed.lateralJoin(spark.tvf.variant_explode(F.col("_list").outer()))
    return each.withColumnRenamed("value", "_value").drop("_list", "key")


def bulletins(pages: DataFrame, body: str = "body") -> DataFrame:
    """List items of envelopes `{success, data: {list: [...]}}`: the pages' other columns, pos, the item and its files.

    A file's address is that of its physical name below `attachmentBase`, else of its image below `imageBase`; a file with
    neither is left out. The pages need `baseUrl`, `frontendBase`, `attachmentBase` and `imageBase`, which may be null.
    """
    rest = [c for c in pages.columns if c != body]
    parsed = pages.withColumn("_body", F.try_parse_json(body)).where(_get("_body", "$.success", "boolean"))
    each = _entries(parsed, _get("_body", "$.data.list", "variant"))
    raw = _get("_value", "$.attachments", "array<struct<logicalName:string,physicalName:string,originalImageUrl:string>>")
    base = F.col("baseUrl")
    url = lambda x: F.when(F.coalesce(x["physicalName"], F.lit("")) != "", F.concat_ws("/", F.coalesce("attachmentBase", base), x["physicalName"])).when(F.coalesce(x["originalImageUrl"], F.lit("")) != "", F.concat(F.coalesce("imageBase", base), x["originalImageUrl"]))
    files = F.filter(F.transform(raw, lambda x: F.struct(F.coalesce(x["logicalName"], F.lit("unknown")).alias("name"), url(x).alias("url"), F.lit(None).cast("string").alias("referer"))), lambda x: x["url"].isNotNull())
    no = _get("_value", "$.id", "long")
    return each.where(no.isNotNull()).select(
        *rest, "pos", no.alias("articleNo"), _text("_value", "$.title").alias("title"), _text("_value", "$.bulletinCategory.name").alias("category"), _text("_value", "$.writer").alias("author"),
        F.left(_text("_value", "$.dateCreated"), F.lit(10)).alias("date"), F.coalesce(_get("_value", "$.hitCnt", "long"), F.lit(0)).alias("views"),
        F.concat_ws("/", F.coalesce("frontendBase", base), no.cast("string")).alias("detailPath"), F.coalesce(files, F.array().cast(ATTACHMENTS)).cast(ATTACHMENTS).alias("attachments"))


def posts(pages: DataFrame, body: str = "body") -> DataFrame:
    """List items of arrays of posts `[{id, title: {rendered}, link, date, content: {rendered}}]`, entities in titles replaced."""
    rest = [c for c in pages.columns if c != body]
    each = _entries(pages, F.try_variant_get(F.try_parse_json(body), "$", "variant"))
    no = _get("_value", "$.id", "long")
    return each.where(no.isNotNull()).select(
        *rest, "pos", no.alias("articleNo"), unescape(_text("_value", "$.title.rendered")).alias("title"), F.substring_index(_text("_value", "$.date"), "T", 1).alias("date"),
        _text("_value", "$.link").alias("detailPath"), F.nullif(_text("_value", "$.content.rendered"), F.lit("")).alias("content"))
