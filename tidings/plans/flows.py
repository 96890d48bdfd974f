"""Whole runs: incremental crawl, update check, summaries, validation and backfills, each as one plan over tables.

A flow takes fetched pages through a `fetch` function (requests with `url` -> with `status` and `body`), so that the network
and a table of pages serve alike, and gives the new state with its counters; its `_changes` form gives what a
merge needs instead, so that only touched buckets are rewritten (see `operators.store`).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.textify import absolute_image_urls, normalize_content_urls, with_representations
from tidings.operators import backfill, changes, enrich, merge, notices, quality, store
from tidings.schemas import KEY
from tidings.session import Config, Watch, small, written
from tidings.sources import readers
from tidings.sources.readers import image_size_udf

Fetch = Callable[[DataFrame], DataFrame]


def scan(state: DataFrame, sources: DataFrame, fetch: Fetch, as_of: str, *, incremental: bool = True, floor: str = changes.FLOOR_DATE, pages: int | None = None, catalogue: readers.Catalogue | None = None) -> tuple[DataFrame, DataFrame]:
    """Items of the list pages that a scan reads, and the pages that could not be fetched where it stopped (sourceId, page).

    Page 0 of every source is fetched first; sources that may go on have 2, 4, 8, ... pages more fetched in the next rounds, up
    to `pages` (100, or 2500 in a full scan). So a cycle without news asks each source once. The known keys are written once,
    by source; each round reads those of the sources that still go on.
    """
    most = pages or (changes.MAX_PAGES if incremental else changes.MAX_PAGES_FULL)
    catalogue, first, size, left = catalogue or readers.Catalogue(sources), 0, 1, sources
    known = store.keys_by_source(state) if incremental else None
    items: list[DataFrame] = []
    failed: list[DataFrame] = []
    while first < most:
        plan = readers.page_plan(left, min(most, first + size), first, catalogue)
        answers = written(fetch(plan).select("sourceId", "page", "status", "body"))
        found = written(readers.read_lists(answers, catalogue, as_of))
        open_keys = changes.of_keys(store.of_sources(known, left), found) if incremental else state.select(*KEY).limit(0)
        read = written(changes.scanned_pages(found, open_keys, plan.select("sourceId", "page"), incremental=incremental, floor=floor, max_pages=most))
        items.append(found.join(read, ["sourceId", "page"], "left_semi"))
        done = read.groupBy("sourceId").agg(F.count(F.lit(1)).alias("n"), F.every("more").alias("more"))
        at = F.when(F.coalesce("more", F.lit(True)), F.coalesce("n", F.lit(0)) + first)
        lost = answers.where("status <> 200").select("sourceId", "page").join(done, "sourceId", "left").where(F.col("page") == at)
        failed.append(lost.select("sourceId", "page"))
        first, size = first + size, 2 * size
        going = done.where(F.col("more") & (F.col("n") == F.lit(min(most, first) - (first - size // 2))))
        left = written(left.join(going.select(F.col("sourceId").alias("id")), "id", "left_semi").select(*left.columns))
        if not left.limit(1).count():
            break
    return reduce(DataFrame.unionByName, items), reduce(DataFrame.unionByName, failed)


def crawl_changes(
    state: DataFrame, sources: DataFrame, fetch: Fetch, now: Column, as_of: str, *, wanted: list[str] | None = None, pages: int | None = None,
    incremental: bool = True, floor: str = changes.FLOOR_DATE, images: Fetch | None = None, observed: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What a crawl found, written: the rows to merge, with their `action`, and per-source counters.

    `observed` gets the totals over all notices, which are counted while the rows are written.

    List pages are read as `scan` says; new and changed notices are fetched and built, unchanged ones touched; notices whose
    content was never had are tried again. In a full crawl known notices of any title count as new and are overwritten.
    With `images`, a fetch of images, their sizes are filled in. A list page that can't be fetched is an error. Of `state`
    only the rows of the chosen sources matter.
    """
    chosen = changes.select_sources(sources, wanted)
    catalogue = readers.Catalogue(chosen)
    seen, failed = scan(state, chosen, fetch, as_of, incremental=incremental, floor=floor, pages=pages, catalogue=catalogue)
    first = written(changes.first_seen(seen, list(KEY), "page"))
    classed = changes.classify(first, changes.of_keys(state, first), floor)
    if not incremental:
        classed = classed.withColumn("action", F.when(F.col("action").isin("changed", "same"), "new").otherwise(F.col("action")))
    classed = written(classed)
    missing = changes.null_content(state).join(small(chosen.select(F.col("id").alias("sourceId"))), "sourceId", "left_semi")
    repairs = written(missing.join(first.select(*KEY), list(KEY), "left_anti"))
    wanted_details = classed.where(F.col("action").isin("new", "changed")).select(*KEY, "detailPath").unionByName(repairs)
    answers = written(fetch(readers.detail_plan(wanted_details, catalogue)))
    details = readers.read_details(answers, catalogue)
    details = written(readers.details_with_list(details, first).select(*KEY, "detail"))
    if images:
        sizes = image_checks(details, chosen, images).select(*KEY, "imageSizes")
        details = details.join(sizes, list(KEY), "left")
    work = classed.join(details, list(KEY), "left").withColumn("crawledAt", now)
    built = notices.build_notices(work, chosen).join(work.select(*KEY, "action", F.col("detail").isNull().alias("_lost")), list(KEY))
    built = built.withColumn("action", F.when(F.col("_lost") & F.col("action").isin("new", "changed"), "error").otherwise(F.col("action"))).drop("_lost")
    mended = state.join(repairs.select(*KEY), list(KEY), "left_semi").select(*KEY, "title", "category", "author", "date", "views", "detailPath")
    mended = notices.build_notices(mended.join(details, list(KEY)).where(F.col("detail").isNotNull()).withColumn("crawledAt", now), chosen).withColumn("action", F.lit("repaired"))
    watch = Watch(**changes.counts_of("action"))
    incoming = written(watch(built.unionByName(mended)))
    if observed is not None:
        observed |= watch.counts()
    counters = changes.outcome_counters(incoming.select("sourceId", "action").unionByName(failed.select("sourceId", F.lit("error").alias("action"))))
    return incoming.where(~F.col("action").isin("old", "error")), counters


def crawl(state: DataFrame, sources: DataFrame, fetch: Fetch, now: Column, as_of: str, **options) -> tuple[DataFrame, DataFrame]:
    """New state and per-source counters of a crawl, with the options of `crawl_changes`."""
    incoming, counters = crawl_changes(state, sources, fetch, now, as_of, **options)
    return merge.merge_notices(state, incoming), counters


def image_checks(details: DataFrame, sources: DataFrame, fetch: Fetch) -> DataFrame:
    """Per notice with images at web addresses: how many were checked, which are broken, and the sizes of the others.

    Each address is fetched once, however many notices show it.
    """
    based = notices.with_source(details.select(*KEY, F.col("detail.content").alias("content")).where("content <> ''"), sources)
    each = written(based.select(*KEY, F.posexplode(absolute_image_urls(normalize_content_urls(F.col("content"), F.col("_base")))).alias("pos", "url")))
    answers = fetch(each.select("url").distinct()).select(F.col("url").alias("_u"), "status", image_size_udf("body").alias("size"))
    j = each.join(answers, F.col("url") == F.col("_u"), "left")
    ok = F.coalesce(F.col("status"), F.lit(0)) == 200
    known = F.when(ok & F.col("size.w").isNotNull(), F.struct("url", F.col("size.w").alias("w"), F.col("size.h").alias("h")))
    broken = F.transform(F.array_sort(F.collect_list(F.when(~ok, F.struct("pos", "url")))), lambda x: x["url"])
    return j.groupBy(*KEY).agg(F.count(F.lit(1)).alias("checked"), broken.alias("broken"), F.array_sort(F.collect_set(known)).alias("imageSizes"))


def check_changes(state: DataFrame, sources: DataFrame, fetch: Fetch, as_of: Column, *, days: int = 14, floor: str = changes.FLOOR_DATE) -> tuple[DataFrame, DataFrame]:
    """What looking again at recent notices with a page address found, written, and per-source counters."""
    catalogue = readers.Catalogue(sources)
    window = merge.check_window(state, as_of, days, floor).where(F.coalesce("detailPath", F.lit("")) != "")
    answers = written(fetch(readers.detail_plan(window.select(*KEY, "detailPath"), catalogue)))
    fresh = with_representations(notices.with_source(readers.read_details(answers, catalogue), sources), F.col("detail.content"), F.col("_base"))
    r = F.col("_r")
    fetched = fresh.select(
        *KEY, "status", r["contentHash"].alias("newHash"), r["content"].alias("content"), r["contentText"].alias("contentText"), r["cleanHtml"].alias("cleanHtml"),
        r["cleanMarkdown"].alias("cleanMarkdown"), F.col("detail.attachments").alias("attachments"))
    told = merge.check_outcomes(window.select(*KEY, "contentHash"), fetched)
    outcomes = written(told.select(*KEY, "outcome", *(c for c in told.columns if c.startswith("_") and c not in ("_sourceId", "_articleNo", "_status"))))
    return outcomes, merge.check_counters(outcomes)


def update_check(state: DataFrame, sources: DataFrame, fetch: Fetch, now: Column, as_of: Column, **options) -> tuple[DataFrame, DataFrame]:
    """New state and per-source counters after looking again at recent notices with a page address."""
    outcomes, counters = check_changes(state, sources, fetch, as_of, **options)
    return merge.apply_check(state, outcomes, now), counters


def reachability(checked: DataFrame, fetch: Fetch) -> DataFrame:
    """Checked attachments with an issue more for each address that answers with an error, or not at all; each is asked once."""
    return quality.with_reachability(checked, fetch(quality.addresses(checked)).select("url", "status"))


def refetch_changes(sources: DataFrame, fetch: Fetch, candidates: DataFrame, *, limit: int | None = None, successes: int | None = None) -> DataFrame:
    """What reading the pages of the candidates again for their attachments found, written.

    `limit` takes so many candidates, by key, whatever becomes of them. `successes` goes on until so many were updated, and
    ends with the last of these: 1, 2, 4, ... times as many candidates are read at a time, in the order of keys.
    """
    catalogue, order = readers.Catalogue(sources), list(KEY)

    def read_again(some: DataFrame) -> DataFrame:
        plan = readers.detail_plan(some.select(*KEY, "detailPath").where(F.coalesce("detailPath", F.lit("")) != ""), catalogue)
        return written(backfill.refetched(some, readers.read_details(written(fetch(plan)), catalogue)))

    some = candidates.orderBy(*order).limit(limit) if limit else candidates
    if successes is None:
        return read_again(some)
    some, size, left, rounds = written(some.select(*KEY, "detailPath")), successes, successes, []
    key, value = F.struct(*order), lambda row: F.struct(*(F.lit(row[c]).alias(c) for c in order))
    last = None  # the greatest key looked at so far
    while left > 0:
        rest = some if last is None else some.where(key > value(last))
        part = written(rest.orderBy(*order).limit(size))
        end = part.orderBy(*(F.desc(c) for c in order)).limit(1).select(*order).first()
        if end is None:
            break
        found, last = read_again(part), end
        updated = found.where("outcome = 'updated'").orderBy(*order)
        nth = updated.offset(left - 1).limit(1).select(*order).first()
        rounds.append(found if nth is None else found.where(key <= value(nth)))
        left = 0 if nth is not None else left - updated.count()
        size *= 2
    return reduce(DataFrame.unionByName, rounds) if rounds else read_again(some)


def refetch_attachments(state: DataFrame, sources: DataFrame, fetch: Fetch, candidates: DataFrame, *, limit: int | None = None, successes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """New state and counters after reading the pages of the candidates again for their attachments; see `refetch_changes`."""
    outcomes = refetch_changes(sources, fetch, candidates, limit=limit, successes=successes)
    return backfill.replace_attachments(state, outcomes.where("outcome = 'updated'").select(*KEY, "attachments")), backfill.backfill_counters(outcomes)


def summaries(state: DataFrame, now: Column, *, limit: int = 50, make_client=lambda: enrich.stub_summary) -> DataFrame:
    """New state after one batch of unsummarised notices and one of notices changed since; the second sees the first's writes."""
    state = enrich.write_summaries(state, enrich.summarise(enrich.pending(state, limit), make_client), now)
    return enrich.write_summaries(state, enrich.summarise(enrich.stale(state, limit), make_client), now)


def broken_images(state: DataFrame, answers: DataFrame, sample: int = 5) -> DataFrame:
    """Per notice how many image addresses were checked and are broken, and the first few of these. `answers`: url, status."""
    each = state.select(*KEY, F.posexplode(absolute_image_urls(F.col("cleanHtml"))).alias("pos", "url"))
    j = each.join(answers.select(F.col("url").alias("_u"), "status"), F.col("url") == F.col("_u"), "left")
    bad = F.coalesce(F.col("status"), F.lit(0)) != 200
    lists = F.transform(F.array_sort(F.collect_list(F.when(bad, F.struct("pos", "url")))), lambda x: x["url"])
    return j.groupBy(*KEY).agg(F.count(F.lit(1)).alias("checked"), F.count_if(bad).alias("broken"), F.slice(lists, 1, sample).alias("sample"))


def validation(state: DataFrame, sources: DataFrame, suffixes: list[str], config: Config | None = None) -> dict[str, DataFrame]:
    """Reports and issue counts of the attachment and Markdown checks."""
    wanted = list(config.source_filter) if config and config.source_filter else None
    files, md = quality.check_attachments(state, sources, suffixes, wanted=wanted), quality.check_markdown(state)
    return {"attachments": quality.report(files), "attachment_counts": quality.issue_counts(files), "markdown": quality.report(md), "markdown_counts": quality.markdown_counts(md)}
