"""Schemas of notices, observations, issues and catalogues. Every field is nullable; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


ATTACHMENT = struct(name=S, url=S, referer=S)
ATTACHMENTS = T.ArrayType(ATTACHMENT)
HISTORY_ENTRY = struct(detectedAt=TS, oldHash=S, newHash=S, oldTitle=S, newTitle=S, titleChanged=B, contentChanged=B, source=S)
LIST_ITEM = struct(articleNo=L, title=S, category=S, author=S, date=S, views=L, detailPath=S)
DETAIL = struct(content=S, contentText=S, attachments=ATTACHMENTS, title=S)
PERIOD = struct(label=S, startDate=S, startTime=S, endDate=S, endTime=S)
SUMMARY_FIELDS = {
    "summary": S, "summaryOneLiner": S, "summaryType": S, "summaryModel": S, "summaryContentHash": S, "summaryPeriods": T.ArrayType(PERIOD),
    "summaryLocations": T.ArrayType(S), "summaryDetails": T.MapType(S, S), "summaryAt": TS, "summaryFailures": I,
}
NOTICE = struct(
    articleNo=L, sourceId=S, title=S, category=S, author=S, department=S, date=S, views=L, content=S, contentText=S, cleanHtml=S,
    cleanMarkdown=S, attachments=ATTACHMENTS, sourceUrl=S, detailPath=S, crawledAt=TS, lastModified=S, contentHash=S,
    editHistory=T.ArrayType(HISTORY_ENTRY), editCount=I, isDeleted=B, consecutiveFailures=I, backfilledAt=TS, **SUMMARY_FIELDS,
)
ATTACHMENT_ISSUE = struct(check=S, attachment_index=I, detail=S, url=S, name=S)
MARKDOWN_ISSUE = struct(check=S, line=I, detail=S, snippet=S, severity=S)
SOURCE = struct(
    id=S, name=S, strategy=S, campus=S, college=S, appCategory=S, crawlAvailable=B, crawlEnabled=B, excludeReason=S, baseUrl=S,
    selectors=T.MapType(S, S), pagination=struct(type=S, param=S, limit=I), extraParams=T.MapType(S, S), boardParams=T.MapType(S, S),
    boardParam=S, boardName=S, boardNo=S, detailMode=S, skinType=S, infoParser=S, attachmentParser=S, categoryId=S,
    bulletinBoardId=S, bulletinCategoryId=S, attachmentBase=S, frontendBase=S, imageBase=S,
)
CATEGORY = struct(
    id=S, label=struct(ko=S, en=S), tabMode=S, fixedSourceId=S, maxSelection=I, defaultIds=T.ArrayType(S), campusDefaultIds=T.MapType(S, T.ArrayType(S)),
)
KEY = ("sourceId", "articleNo")
