"""Merging observations into the notice table: one join, one action a row, one expression a column.

State and changes are keyed by (sourceId, articleNo); both sides are hashed on the key once. Parquet has no merge, so a
merge gives the whole new state, which `Store` writes as a version and then names current.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.schemas import HISTORY_ENTRY, KEY, NOTICE, SUMMARY_FIELDS
from tidings.session import small

HISTORY = 20  # entries kept
DELETED_AFTER = 3  # failures in a row
CRAWLED = [
    "title", "category", "author", "department", "date", "views", "content", "contentText", "cleanHtml", "cleanMarkdown", "attachments",
    "sourceUrl", "detailPath", "crawledAt", "lastModified", "contentHash",
]


def tail(array: Column, n: int) -> Column:
    """The last n elements, all of a shorter array."""
    return F.slice(array, F.greatest(F.size(array) - n + 1, F.lit(1)), F.lit(n))


def with_history(history: Column, entry: Column, n: int = HISTORY) -> Column:
    return tail(F.concat(F.coalesce(history, F.array().cast(T.ArrayType(HISTORY_ENTRY))), F.array(entry)), n)


def history_entry(detected: Column, old_hash: Column, new_hash: Column, old_title: Column, new_title: Column, source: str) -> Column:
    titled = source == "tier1"
    none = F.lit(None).cast("string")
    return F.struct(
        detected.alias("detectedAt"), old_hash.alias("oldHash"), new_hash.alias("newHash"), (old_title if titled else none).alias("oldTitle"),
        (new_title if titled else none).alias("newTitle"), ((~old_title.eqNullSafe(new_title)) if titled else F.lit(None).cast("boolean")).alias("titleChanged"),
        (~old_hash.eqNullSafe(new_hash)).alias("contentChanged"), F.lit(source).alias("source")).cast(HISTORY_ENTRY)


def merge_notices(state: DataFrame, incoming: DataFrame) -> DataFrame:
    """State after full upserts (`action` new or changed), touches (same) and content repairs (repaired).

    New rows start with an empty history and no failures. A known row that comes as new is overwritten but keeps history,
    counters and flags; one that comes as changed gets a history entry, of which the last 20 stay, and one edit more; a
    touched row gets views and time only; a repaired one its content. All other columns of the state stay.
    """
    new = incoming.select(*(F.col(c).alias(f"_{c}") for c in (*KEY, "action", *CRAWLED)))
    on = (F.col("sourceId") == F.col("_sourceId")) & (F.col("articleNo") == F.col("_articleNo"))
    j = state.withColumn("_old", F.lit(True)).join(new, on, "full_outer")
    known, action = F.col("_old").isNotNull(), F.col("_action")
    write = action.isin("new", "changed")
    repaired = ["content", "contentText", "cleanHtml", "cleanMarkdown", "attachments", "contentHash", "crawledAt"]
    out: dict[str, Column] = {k: F.coalesce(k, f"_{k}") for k in KEY}
    for c in CRAWLED:
        value = F.when(write, F.col(f"_{c}"))
        if c in ("views", "crawledAt"):
            value = value.when(action == "same", F.col(f"_{c}"))
        if c in repaired:
            value = value.when(action == "repaired", F.col(f"_{c}"))
        out[c] = value.otherwise(F.col(c))
    edited = known & (action == "changed")
    entry = history_entry(F.col("_crawledAt"), F.col("contentHash"), F.col("_contentHash"), F.col("title"), F.col("_title"), "tier1")
    out["editHistory"] = F.when(edited, with_history(F.col("editHistory"), entry)).when(known, F.col("editHistory")).otherwise(F.array().cast(T.ArrayType(HISTORY_ENTRY)))
    out["editCount"] = F.when(edited, F.coalesce("editCount", F.lit(0)) + 1).when(known, F.col("editCount")).otherwise(F.lit(0)).cast("int")
    out["isDeleted"] = F.when(known, F.col("isDeleted")).otherwise(F.lit(False))
    out["consecutiveFailures"] = F.when(known, F.col("consecutiveFailures")).otherwise(F.lit(0)).cast("int")
    keep = known | write
    return j.where(keep).select(*(out.get(c, F.col(c)).alias(c) for c in state.columns))


def check_outcomes(state: DataFrame, fetched: DataFrame) -> DataFrame:
    """The update check's view of each fetched notice: `outcome` and the new representations.

    `fetched`: key, status, newHash, and the new content columns. Outcomes: notFound (404), error (no content), backfilled
    (the state had no hash), same, changed.
    """
    new = fetched.select(*(F.col(c).alias(f"_{c}") for c in fetched.columns))
    j = state.join(new, (F.col("sourceId") == F.col("_sourceId")) & (F.col("articleNo") == F.col("_articleNo")), "inner")
    outcome = (
        F.when(F.col("_status") == 404, "notFound").when((F.col("_status") != 200) | F.col("_newHash").isNull(), "error")
        .when(F.col("contentHash").isNull(), "backfilled").when(F.col("contentHash") == F.col("_newHash"), "same").otherwise("changed")
    )
    return j.withColumn("outcome", outcome)


def mass_not_found(outcomes: DataFrame) -> DataFrame:
    """Sources where so many notices are missing that the source itself is in doubt: of 5 or more tried, over half."""
    missing, tried = F.count_if(F.col("outcome") == "notFound"), F.count(F.lit(1))
    return outcomes.groupBy("sourceId").agg(((tried >= 5) & (missing / tried > 0.5)).alias("massNotFound"))


def apply_check(state: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """State after the update check: backfilled hashes, changes with history, failure counts and soft deletion.

    Missing notices of a source in doubt are left alone. A third failure in a row marks the notice deleted; an unchanged
    page takes the count back to zero; nothing undeletes.
    """
    gate = small(mass_not_found(outcomes).withColumnRenamed("sourceId", "_gs"))
    fresh = ["content", "contentText", "cleanHtml", "cleanMarkdown", "attachments"]
    gated = outcomes.join(gate, F.col("sourceId") == F.col("_gs"), "left")  # outcomes, not the state, meet the few sources
    o = gated.select(F.col("sourceId").alias("_s"), F.col("articleNo").alias("_a"), F.col("outcome").alias("_o"), "massNotFound", F.col("_newHash"), *(F.col(f"_{c}") for c in fresh if f"_{c}" in outcomes.columns))
    j = state.join(o, (F.col("sourceId") == F.col("_s")) & (F.col("articleNo") == F.col("_a")), "left")
    is_ = lambda *x: F.col("_o").isin(*x)
    failed = is_("notFound") & ~F.coalesce("massNotFound", F.lit(False))
    failures = F.coalesce("consecutiveFailures", F.lit(0)) + 1
    entry = history_entry(now, F.col("contentHash"), F.col("_newHash"), F.col("title"), F.col("title"), "tier2")
    out = {c: F.when(is_("changed"), F.coalesce(F.col(f"_{c}"), F.col(c))).otherwise(F.col(c)) for c in fresh if f"_{c}" in outcomes.columns}
    out |= {
        "contentHash": F.when(is_("backfilled", "changed"), F.col("_newHash")).otherwise(F.col("contentHash")),
        "crawledAt": F.when(is_("backfilled", "changed"), now).otherwise(F.col("crawledAt")),
        "editHistory": F.when(is_("changed"), with_history(F.col("editHistory"), entry)).otherwise(F.col("editHistory")),
        "editCount": F.when(is_("changed"), F.coalesce("editCount", F.lit(0)) + 1).otherwise(F.col("editCount")).cast("int"),
        "consecutiveFailures": F.when(failed, failures).when(is_("same", "backfilled", "changed"), 0).otherwise(F.col("consecutiveFailures")).cast("int"),
        "isDeleted": F.when(failed & (failures >= DELETED_AFTER), True).when(failed, F.coalesce("isDeleted", F.lit(False))).otherwise(F.col("isDeleted")),
    }
    return j.select(*(out.get(c, F.col(c)).alias(c) for c in state.columns))


def check_counters(outcomes: DataFrame) -> DataFrame:
    """Per source what the update check found, and whether the rate of change is odd: over 0.3 a warning, over 0.8 an error."""
    n = lambda x: F.count_if(F.col("outcome") == x).cast("long")
    c = outcomes.groupBy("sourceId").agg(
        (n("same") + n("changed") + n("backfilled")).alias("checked"), n("changed").alias("changed"), n("backfilled").alias("backfilled"),
        n("notFound").alias("notFound"), n("error").alias("errors"))
    base = F.col("checked") - F.col("backfilled")
    rate = F.when(base > 0, F.round(F.col("changed") / base, 2))
    exact = F.when(base > 0, F.col("changed") / base)
    return c.withColumns({"changeRate": rate, "alert": F.when(exact > 0.8, "error").when(exact > 0.3, "warning").otherwise("none")})


def check_window(state: DataFrame, as_of: Column, days: int, floor: str) -> DataFrame:
    """Notices that the update check looks at: dated since the floor or for so many days, and not deleted."""
    since = F.greatest(F.lit(floor), F.date_format(F.date_sub(as_of, days), "yyyy-MM-dd"))
    return state.where((F.col("date") >= since) & ~F.coalesce("isDeleted", F.lit(False)))


def summarised(state: DataFrame, names: list[str] = tuple(SUMMARY_FIELDS)) -> DataFrame:
    """Notices in which any of the summary's fields is set."""
    return state.where(F.coalesce(*(F.col(n).cast("string") if not isinstance(state.schema[n].dataType, (T.ArrayType, T.MapType)) else F.to_json(n) for n in names if n in state.columns)).isNotNull())


def unset_fields(state: DataFrame, names: list[str] = tuple(SUMMARY_FIELDS)) -> DataFrame:
    """State with the fields emptied."""
    return state.withColumns({n: F.lit(None).cast(state.schema[n].dataType) for n in names if n in state.columns})


def duplicate_keys(state: DataFrame) -> DataFrame:
    """Keys that occur more than once; a sound state has none."""
    return state.groupBy(*KEY).count().where("count > 1")


def last_change(state: DataFrame) -> DataFrame:
    """Key and latest history entry of each notice that has one."""
    return state.where(F.size("editHistory") > 0).select(*KEY, F.element_at("editHistory", -1).alias("entry"))


class Store:
    """A notice table in versions: a folder of Parquet for each, and a mark for each that is complete, written last.

    The current version is the greatest marked one. What a writer that died left behind has no mark, is never read and never
    written over. Of two writers that make the same version the later one fails.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = NOTICE):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _current(self) -> tuple[int, str | None]:
        try:
            marks = self.spark.read.schema("n int, folder string").option("recursiveFileLookup", "true").parquet(f"{self.path}/complete")
            row = marks.agg(F.max(F.struct("n", "folder")).alias("x")).select("x.*").first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, None
        return row["n"] or 0, row["folder"]

    def version(self) -> int:
        return self._current()[0]

    def read(self) -> DataFrame:
        n, folder = self._current()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}") if n else self.spark.createDataFrame([], self.schema)

    def write(self, state: DataFrame) -> int:
        """Write the next version, ranged and sorted by source and date so that scans of one source read few files, and mark it."""
        n = self.version() + 1
        folder = f"v{n}-{uuid.uuid4().hex}"
        rows = state.select(*(F.col(f.name).cast(f.dataType) for f in self.schema))
        rows.repartitionByRange("sourceId", F.desc("date"), "articleNo").sortWithinPartitions("sourceId", F.desc("date")).write.parquet(f"{self.path}/{folder}")
        mark = self.spark.range(1).select(F.lit(n).alias("n"), F.lit(folder).alias("folder")).coalesce(1)
        mark.write.mode("error").parquet(f"{self.path}/complete/v={n}")
        return n
