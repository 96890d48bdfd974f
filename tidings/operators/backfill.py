"""Backfills: which notices they concern, and the patched columns. `apply=False` only counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.textify import with_representations
from tidings.functions.urls import source_url_expr
from tidings.operators.quality import NEEDS_REFERER
from tidings.schemas import ATTACHMENTS, KEY


def content_candidates(state: DataFrame) -> DataFrame:
    return state.where(F.col("content").isNotNull() | F.col("detailPath").isNotNull())


def referer_candidates(state: DataFrame) -> DataFrame:
    """Notices with attachments of which none has a referer."""
    any_referer = F.exists("attachments", lambda a: a["referer"].isNotNull())
    return state.where(F.col("attachments").isNotNull() & (F.size("attachments") > 0) & ~any_referer)


def empty_attachment_candidates(state: DataFrame) -> DataFrame:
    """Notices whose attachment list is there and empty."""
    return state.where(F.col("attachments").isNotNull() & (F.size("attachments") == 0))


def download_manager_candidates(state: DataFrame) -> DataFrame:
    """Notices with an attachment that leads to a landing page instead of the file."""
    return state.where(F.exists("attachments", lambda a: a["url"].contains("/download/") & ~a["url"].contains("wpdmdl=")))


def detail_url(path: Column, source: Column, no: Column) -> Column:
    """Detail page of the two gnuboard kinds from the stored path and the catalogue entry."""
    base = F.concat(source["baseUrl"], F.lit("?"), source["boardParam"], F.lit("="), source["boardName"])
    custom = F.concat(base, F.lit("&mode="), source["detailMode"], F.lit("&num="), no.cast("string"))
    plain = F.concat(base, F.lit("&wr_id="), no.cast("string"))
    return F.when(path.startswith("http"), path).when(path.startswith("?"), F.concat(source["baseUrl"], path)).when(source["strategy"] == "gnuboard-custom", custom).otherwise(plain)


def patch_referer(attachments: Column, referer: Column) -> Column:
    """Every attachment with the referer; null if all have one already."""
    complete = F.forall(attachments, lambda a: a["referer"].isNotNull())
    return F.when(~complete, F.transform(attachments, lambda a: a.withField("referer", referer)))


def backfill_content(state: DataFrame, sources: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """New representations of all candidates, and counts. Notices of a source without an address are skipped."""
    known = sources.select(F.col("id").alias("_id"), F.col("baseUrl").alias("_base"))
    j = content_candidates(state).join(known, F.col("sourceId") == F.col("_id"), "left")
    usable = F.coalesce(F.col("_base"), F.lit("")) != ""
    counts = j.agg(F.count(F.lit(1)).alias("matched"), F.count_if(~usable).alias("skipped"))
    url = F.when(F.col("detailPath").isNotNull(), source_url_expr(F.col("_base"), F.col("detailPath"))).otherwise(F.col("sourceUrl"))
    has = F.coalesce(F.col("content") != "", F.lit(False))
    made = with_representations(j.where(usable).withColumn("_url", url), F.when(has, F.col("content")), F.col("_base"))
    r = F.col("_r")
    fresh = {c: F.when(has, r[c]).otherwise(F.col(c)) for c in ("cleanHtml", "cleanMarkdown", "contentHash")}
    fresh["contentText"] = F.when(has & r["cleanHtml"].isNotNull(), r["contentText"]).otherwise(F.col("contentText"))
    out = made.withColumns(fresh | {"sourceUrl": F.col("_url"), "backfilledAt": now}).select(*state.columns)
    return out, counts


def backfill_referer(state: DataFrame, sources: DataFrame) -> DataFrame:
    """Keys and patched attachments of notices on boards that demand a referer."""
    known = sources.where(F.col("strategy").isin(*NEEDS_REFERER)).select(F.col("id").alias("_id"), F.struct("baseUrl", "boardParam", "boardName", "detailMode", "strategy").alias("_c"))
    j = referer_candidates(state).join(known, F.col("sourceId") == F.col("_id"))
    patched = patch_referer(F.col("attachments"), detail_url(F.coalesce("detailPath", F.lit("")), F.col("_c"), F.col("articleNo")))
    return j.select(*KEY, patched.alias("attachments")).where(F.col("attachments").isNotNull())


def replace_attachments(state: DataFrame, found: DataFrame) -> DataFrame:
    """State with the non-empty attachment lists of `found` (key, attachments) in place of its own."""
    new = found.where(F.size("attachments") > 0).select(F.col("sourceId").alias("_s"), F.col("articleNo").alias("_a"), F.col("attachments").cast(ATTACHMENTS).alias("_new"))
    j = state.join(new, (F.col("sourceId") == F.col("_s")) & (F.col("articleNo") == F.col("_a")), "left")
    return j.select(*(F.coalesce("_new", "attachments").alias(c) if c == "attachments" else F.col(c) for c in state.columns))


def replace_rows(state: DataFrame, rows: DataFrame) -> DataFrame:
    """State with whole rows in place of those of the same key."""
    return state.join(rows.select(*KEY), list(KEY), "left_anti").select(*state.columns).unionByName(rows.select(*state.columns))


def on_boards(candidates: DataFrame, sources: DataFrame, strategy: str, without_base: str | None = None) -> DataFrame:
    """Candidates on one kind of board, less those whose address contains `without_base`."""
    known = sources.where(F.col("strategy") == strategy)
    known = known.where(~F.col("baseUrl").contains(without_base)) if without_base else known
    return candidates.join(known.select(F.col("id").alias("sourceId")), "sourceId", "left_semi")


def refetched(candidates: DataFrame, details: DataFrame) -> DataFrame:
    """Key, `outcome` and new `attachments` of re-fetched notices: updated, unchanged (none found), failed, skipped (no address)."""
    d = details.select(F.col("sourceId").alias("_s"), F.col("articleNo").alias("_a"), "status", F.col("detail.attachments").alias("_found"), F.col("detail").isNotNull().alias("_read"))
    j = candidates.select(*KEY, "detailPath").join(d, (F.col("sourceId") == F.col("_s")) & (F.col("articleNo") == F.col("_a")), "left")
    outcome = (
        F.when(F.coalesce("detailPath", F.lit("")) == "", "skipped").when(~F.coalesce("_read", F.lit(False)) & (F.coalesce("status", F.lit(0)) != 200), "failed")
        .when(F.coalesce(F.size("_found"), F.lit(0)) < 1, "unchanged").otherwise("updated")
    )
    return j.select(*KEY, outcome.alias("outcome"), F.col("_found").cast(ATTACHMENTS).alias("attachments"))


def backfill_counters(outcomes: DataFrame) -> DataFrame:
    """How many notices had each outcome, and the exit code of the run: 2 if any failed, else 0."""
    n = lambda x: F.count_if(F.col("outcome") == x)
    return outcomes.agg(n("updated").alias("updated"), n("unchanged").alias("unchanged"), n("skipped").alias("skipped"), n("failed").alias("failed"), F.when(n("failed") > 0, 2).otherwise(0).alias("exitCode"))


def gate(candidates: DataFrame, apply: bool) -> tuple[int, bool]:
    """How many notices a backfill concerns, and whether it may go on."""
    n = candidates.count()
    return n, apply and n > 0
