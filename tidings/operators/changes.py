"""Change detection between observations and state, and the page scan's early stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidings.session import small

FLOOR_DATE = "2026-03-09"  # fixed value: notices dated before are not taken
MAX_PAGES, MAX_PAGES_FULL = 100, 2500
FEW = 100_000  # keys that are broadcast


def too_old(date: Column, floor: str = FLOOR_DATE) -> Column:
    """Dated before the floor; an unknown date never is."""
    return (F.coalesce(date, F.lit("")) != "") & (date < floor)


def title_cut_short(new: Column, old: Column) -> Column:
    """Is the new title a shortened form of the old one: its part before a final `...`, less broken characters, begins it?"""
    prefix = F.regexp_replace(F.left(new, F.length(new) - 3), "�+$", "")
    return new.endswith("...") & (prefix != "") & old.startswith(prefix)


def has_changed(title: Column, date: Column, old_title: Column, old_date: Column) -> Column:
    """Another date, or another title that isn't just cut short."""
    other_date = ~F.coalesce(date, F.lit("")).eqNullSafe(F.coalesce(old_date, F.lit("")))
    t, o = F.coalesce(title, F.lit("")), F.coalesce(old_title, F.lit(""))
    return other_date | ((t != o) & ~title_cut_short(t, o))


def existing_meta(state: DataFrame) -> DataFrame:
    return state.select("sourceId", "articleNo", F.col("title").alias("oldTitle"), F.col("date").alias("oldDate"), F.col("contentHash").alias("oldHash"))


def of_keys(state: DataFrame, items: DataFrame) -> DataFrame:
    """The state's rows that the items can meet: where items are few, counted, they are broadcast and the rest of the state isn't shuffled."""
    keys = items.select("sourceId", "articleNo")
    few = small(keys, FEW)
    return state if few is keys else state.join(few, ["sourceId", "articleNo"], "left_semi")


def classify(items: DataFrame, state: DataFrame, floor: str = FLOOR_DATE) -> DataFrame:
    """Items with the state's title, date and hash and an `action`: old, new, changed or same."""
    meta = existing_meta(state).withColumn("_known", F.lit(True))
    joined = items.join(meta, ["sourceId", "articleNo"], "left")
    action = (
        F.when(too_old(F.col("date"), floor), "old").when(F.col("_known").isNull(), "new")
        .when(has_changed(F.col("title"), F.col("date"), F.col("oldTitle"), F.col("oldDate")), "changed").otherwise("same")
    )
    return joined.withColumn("action", action).drop("_known")


def scanned_pages(items: DataFrame, state: DataFrame, planned: DataFrame, *, incremental: bool = True, floor: str = FLOOR_DATE, max_pages: int | None = None) -> DataFrame:
    """Of the planned pages (sourceId, page) those that a scan reads, and whether it may go on behind them (`more`).

    A scan ends before its first empty page and before its first page of nothing but old notices; an incremental one also
    before the first page whose notices are all known, except that page 0 is read even then, and nothing after it.
    """
    known = state.select("sourceId", "articleNo").withColumn("_known", F.lit(True))
    facts = items.join(known, ["sourceId", "articleNo"], "left").groupBy("sourceId", "page").agg(
        F.every(too_old(F.col("date"), floor)).alias("_old"), F.every(F.col("_known").isNotNull()).alias("_all_known"))
    stop = F.col("_old").isNull() | F.col("_old")
    last = F.lit(False)
    if incremental:
        stop = stop | (F.col("_all_known") & (F.col("page") > 0))
        last = F.coalesce("_all_known", F.lit(False)) & (F.col("page") == 0)
    limit = max_pages or (MAX_PAGES if incremental else MAX_PAGES_FULL)
    pages = planned.where(F.col("page") < limit).join(facts, ["sourceId", "page"], "left").withColumns({"_stop": stop, "_last": last})
    up_to = Window.partitionBy("sourceId").orderBy("page")
    ended = F.max(F.when(F.col("_stop"), 1).otherwise(0)).over(up_to)
    after = F.max(F.when(F.col("_last"), 1).otherwise(0)).over(up_to.rowsBetween(Window.unboundedPreceding, -1))
    read = pages.withColumns({"_ended": ended, "_after": F.coalesce(after, F.lit(0))}).where("_ended = 0 AND _after = 0")
    return read.select("sourceId", "page", (~F.col("_last")).alias("more"))


def latest_by(rows: DataFrame, key: str, order: list[Column | str], k: int) -> DataFrame:
    """The first `k` rows of each key in the given order, numbered by `rn`."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rn") <= k)


def first_seen(items: DataFrame, key: list[str], by: str) -> DataFrame:
    """Of rows with an equal key the first by `by`, whole."""
    rest = [c for c in items.columns if c not in key]
    return items.groupBy(*key).agg(F.min_by(F.struct(*rest), by).alias("x")).select(*key, "x.*")


def null_content(state: DataFrame) -> DataFrame:
    """References of notices whose content was never had."""
    missing = F.col("content").isNull() | (F.col("content") == "")
    return state.where(missing).select("sourceId", "articleNo", F.coalesce("detailPath", F.lit("")).alias("detailPath"))


def select_sources(sources: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """The wanted sources, all of which must exist; else those that can be crawled and are switched on."""
    if wanted is None:
        return sources.where(F.coalesce("crawlAvailable", F.lit(False)) & F.coalesce("crawlEnabled", F.lit(False)))
    asked = sources.sparkSession.createDataFrame([(w,) for w in wanted], "id string").distinct()
    unknown = [r["id"] for r in unknown_ids(asked, sources, "id").orderBy("id").collect()]
    if unknown:
        raise ValueError(f"unknown sources: {', '.join(unknown)}")
    return sources.join(asked, "id", "left_semi")


def unknown_ids(asked: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """The different values of `on` that are asked for and not known."""
    return asked.select(on).distinct().join(known.select(on), on, "left_anti")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, with repeats, that only one of two tables of equal columns has: `side` says which."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def repeated(rows: DataFrame, key: str, by: str) -> DataFrame:
    """Keys that occur more than once, with the first by `by` and how many there are."""
    return rows.groupBy(key).agg(F.min(by).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")


def counts_of(action: str) -> dict[str, Column]:
    """What a crawl counts of its notices' actions."""
    count = lambda *xs: F.count_if(F.col(action).isin(*xs))
    return {"inserted": count("new"), "updated": count("changed", "repaired"), "skipped": count("same", "old"), "errors": count("error")}


def outcome_counters(actions: DataFrame) -> DataFrame:
    """Per source: inserted, updated, skipped, errors."""
    return actions.groupBy("sourceId").agg(*(v.alias(k) for k, v in counts_of("action").items()))


def total_counters(counters: DataFrame) -> DataFrame:
    return counters.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters.columns if c != "sourceId"))
