"""The source and category catalogues: loading, rules, and what is generated from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidings.schemas import CATEGORY, SOURCE
from tidings.sources.boards import FEATURES, REQUIRED_SELECTORS

# Fixed values.
CAMPUSES = ("hssc", "nsc", "both")
CAMPUS_KEYS = ("hssc", "nsc")
TAB_MODES = ("fixed", "picker")
EXCLUDE_REASONS = ("loginRequired", "noWebsite", "externalSystem", "accessRestricted", "temporarilyUnavailable")
REQUIRED_FIELDS = ("id", "name", "strategy", "campus", "college", "appCategory", "crawlAvailable", "crawlEnabled", "excludeReason")


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue from a JSON array, in the file's order (`pos`), with the names of the fields that each entry has (`present`)."""
    return _numbered(spark, path, SOURCE)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return _numbered(spark, path, CATEGORY)


def _numbered(spark: SparkSession, path: str, schema) -> DataFrame:
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "json"))
    parsed = raw.select("pos", F.json_object_keys("json").alias("present"), F.from_json("json", schema).alias("x"))
    return parsed.select("pos", "present", "x.*")


def _rule(rows: DataFrame, when: Column, entity: Column, rule: str, message: Column) -> DataFrame:
    return rows.where(when).select(entity.alias("entity"), F.lit(rule).alias("rule"), message.alias("message"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def selector_errors(sources: DataFrame) -> DataFrame:
    """(entity, rule, message) of entries whose board is unknown or lacks a selector, and of ids after their first use."""
    rules = sources.sparkSession.createDataFrame([(k, v) for k, v in REQUIRED_SELECTORS.items()], "_strategy string, _required array<string>")
    j = sources.join(F.broadcast(rules), F.col("strategy") == F.col("_strategy"), "left")  # one row for each kind of board
    has = F.coalesce(F.map_keys("selectors"), F.array().cast("array<string>"))
    missing = j.where(F.col("selectors").isNotNull()).select("id", "strategy", F.explode(F.array_except("_required", has)).alias("s"))
    return _union([
        _rule(j, F.col("_strategy").isNull(), F.col("id"), "unknown_strategy", F.concat(F.lit("unknown strategy "), F.coalesce("strategy", F.lit("")))),
        _rule(j, (F.size("_required") > 0) & F.col("selectors").isNull(), F.col("id"), "missing_selectors", F.lit("missing selectors object")),
        _rule(missing, F.lit(True), F.col("id"), "missing_selector", F.concat(F.lit("missing selector "), F.col("s"))),
        _repeated(sources),
    ])


def _repeated(rows: DataFrame) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("id").orderBy("pos"))
    return _rule(rows.withColumn("_nth", nth), F.col("_nth") > 1, F.col("id"), "duplicate_id", F.lit("duplicate ID"))


def source_errors(sources: DataFrame, categories: DataFrame) -> DataFrame:
    """The catalogue's rules on sources."""
    known = categories.select(F.col("id").alias("_cat")).distinct()
    j = sources.join(known, F.col("appCategory") == F.col("_cat"), "left")
    absent = sources.select("id", F.explode(F.array_except(F.array(*map(F.lit, REQUIRED_FIELDS)), "present")).alias("f"))
    avail, on, why, e = F.col("crawlAvailable"), F.col("crawlEnabled"), F.col("excludeReason"), F.col("id")
    text = lambda *parts: F.concat(*(F.coalesce(p, F.lit("null")) if isinstance(p, Column) else F.lit(p) for p in parts))
    return _union([
        _rule(absent, F.lit(True), F.col("id"), "missing_field", text("missing required field ", F.col("f"))),
        _repeated(sources),
        _rule(j, F.col("strategy").isNotNull() & ~F.col("strategy").isin(*FEATURES), e, "unknown_strategy", text("unknown strategy ", F.col("strategy"))),
        _rule(j, F.col("campus").isNotNull() & ~F.col("campus").isin(*CAMPUSES), e, "invalid_campus", text("invalid campus ", F.col("campus"))),
        _rule(j, F.col("appCategory").isNotNull() & F.col("_cat").isNull(), e, "invalid_category", text("invalid appCategory ", F.col("appCategory"))),
        _rule(j, avail.isNull(), e, "available_not_boolean", F.lit("crawlAvailable must be boolean")),
        _rule(j, on.isNull(), e, "enabled_not_boolean", F.lit("crawlEnabled must be boolean")),
        _rule(j, why.isNotNull() & ~why.isin(*EXCLUDE_REASONS), e, "invalid_reason", text("invalid excludeReason ", why)),
        _rule(j, ~avail & why.isNull(), e, "unavailable_without_reason", F.lit("crawlAvailable=false requires an excludeReason")),
        _rule(j, avail & why.isNotNull(), e, "available_with_reason", F.lit("crawlAvailable=true must have no excludeReason")),
        _rule(j, ~avail & on, e, "unavailable_enabled", F.lit("crawlAvailable=false forbids crawlEnabled=true")),
    ])


def seed_size(common: Column, campus: Column) -> Column:
    """How many different sources two lists of defaults select together."""
    return F.size(F.array_union(common, campus))


def category_errors(categories: DataFrame, sources: DataFrame) -> DataFrame:
    """The catalogue's rules on categories."""
    e, n = F.col("id"), F.col("maxSelection")
    s = sources.select(F.col("id").alias("_sid"), F.col("appCategory").alias("_cat"), F.col("crawlAvailable").alias("_avail"), F.col("crawlEnabled").alias("_on"))
    fixed = categories.where("tabMode = 'fixed'").join(s, F.col("fixedSourceId") == F.col("_sid"), "left")
    matched = s.groupBy("_cat").agg(F.count(F.lit(1)).alias("_n"), F.collect_set(F.when(F.col("_avail") & F.col("_on"), F.col("_sid"))).alias("_enabled"))
    picker = categories.where("tabMode = 'picker'").join(matched, F.col("id") == F.col("_cat"), "left").withColumn("_enabled", F.coalesce("_enabled", F.array().cast("array<string>")))
    common = picker.select("id", F.explode(F.array_except("defaultIds", "_enabled")).alias("d"))
    campus = picker.select("id", "maxSelection", "defaultIds", "_enabled", F.explode("campusDefaultIds").alias("k", "ids"))
    good_key = F.col("k").isin(*CAMPUS_KEYS)
    per_campus = campus.where(good_key).select("id", "k", F.explode(F.array_except("ids", "_enabled")).alias("d"))
    seed = seed_size(F.col("defaultIds"), F.col("ids"))
    labels = categories.select("id", F.explode(F.array(*(F.when(F.col(f"label.{x}").isNull(), F.lit(x)) for x in ("ko", "en")))).alias("l"))
    orphans = sources.where(F.col("appCategory").isNotNull()).join(categories.select(F.col("id").alias("_c")), F.col("appCategory") == F.col("_c"), "left_anti").select("appCategory").distinct()
    return _union([
        _repeated(categories),
        _rule(categories, F.col("tabMode").isNull() | ~F.col("tabMode").isin(*TAB_MODES), e, "invalid_tab_mode", F.concat(F.lit("invalid tabMode "), F.coalesce("tabMode", F.lit("null")))),
        _rule(labels, F.col("l").isNotNull(), e, "missing_label", F.concat(F.lit("missing label."), F.col("l"))),
        _rule(fixed, F.coalesce("fixedSourceId", F.lit("")) == "", e, "no_fixed_source", F.lit("fixed mode requires fixedSourceId")),
        _rule(fixed, (F.col("fixedSourceId") != "") & F.col("_sid").isNull(), e, "unknown_fixed_source", F.concat(F.lit("unknown fixedSourceId "), F.col("fixedSourceId"))),
        _rule(fixed, F.col("_sid").isNotNull() & ~F.coalesce("_avail", F.lit(False)), e, "unavailable_fixed_source", F.concat(F.lit("fixedSourceId can't be crawled: "), F.col("fixedSourceId"))),
        _rule(picker, n.isNull() | (n < 1), e, "invalid_max_selection", F.lit("picker mode requires a positive maxSelection")),
        _rule(picker, F.col("_n").isNull(), e, "no_match", F.lit("picker matches 0 departments")),
        _rule(common, F.lit(True), e, "default_not_enabled", F.concat(F.lit("defaultId not enabled: "), F.col("d"))),
        _rule(campus, ~good_key, e, "invalid_campus_key", F.concat(F.lit("invalid campusDefaultIds key "), F.col("k"))),
        _rule(per_campus, F.lit(True), e, "campus_default_not_enabled", F.concat(F.lit("campusDefaultIds."), F.col("k"), F.lit(" not enabled: "), F.col("d"))),
        _rule(campus, good_key & F.col("defaultIds").isNotNull() & (seed > n), e, "seed_above_max", F.concat(F.lit("seed for campus "), F.col("k"), F.lit(" is above maxSelection"))),
        _rule(orphans, F.lit(True), F.col("appCategory"), "category_without_entry", F.lit("appCategory has no entry")),
    ])


def load_and_validate(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue, or an error that names every violation of the loader's rules."""
    sources = read_sources(spark, path)
    errors = [f"{r.entity}: {r.message}" for r in selector_errors(sources).orderBy("entity", "rule", "message").collect()]
    if errors:
        raise ValueError("\n".join(errors))
    return sources


# Artifacts: each a DataFrame of one string column `text` in the order of `pos`, or one row.


def source_enum(sources: DataFrame) -> DataFrame:
    """Lines of an enumeration of the ids."""
    return sources.select("pos", F.concat(F.upper(F.translate("id", "-", "_")), F.lit(' = "'), F.col("id"), F.lit('"')).alias("text")).orderBy("pos")


def server_sources(sources: DataFrame) -> DataFrame:
    """One JSON object a source, with what its kind of board can show."""
    shown = sources.sparkSession.createDataFrame([(k, *v) for k, v in FEATURES.items()], "_s string, hasCategory boolean, hasAuthor boolean")
    j = sources.join(F.broadcast(shown), F.col("strategy") == F.col("_s"), "left")  # one row for each kind of board
    fields = ("id", "name", "campus", "college", "appCategory", "crawlAvailable", "excludeReason", "hasCategory", "hasAuthor")
    return j.select("pos", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("text")).orderBy("pos")


def filter_line(sources: DataFrame) -> DataFrame:
    """The environment line with the ids that are crawled, in the catalogue's order."""
    on = sources.where(F.col("crawlAvailable") & F.col("crawlEnabled"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]), ",")
    return on.agg(F.concat(F.lit("CRAWL_SOURCE_FILTER="), ids).alias("text"))


def server_categories(categories: DataFrame, sources: DataFrame) -> DataFrame:
    """One JSON object a category; pickers list the sources that can be crawled or say why not."""
    s = sources.where(F.col("crawlAvailable") | F.col("excludeReason").isNotNull())
    listed = s.groupBy(F.col("appCategory").alias("_c")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("sourceIds"))
    j = categories.join(listed, F.col("id") == F.col("_c"), "left")
    fixed = F.to_json(F.struct("id", "label", "tabMode", F.col("fixedSourceId").alias("sourceId")))
    picker = F.to_json(F.struct("id", "label", "tabMode", F.coalesce("sourceIds", F.array().cast("array<string>")).alias("sourceIds"), "maxSelection", "defaultIds", "campusDefaultIds"))
    return j.select("pos", F.when(F.col("tabMode") == "fixed", fixed).otherwise(picker).alias("text")).orderBy("pos")


def strategy_histogram(sources: DataFrame) -> DataFrame:
    """Sources of each kind of board, numbered by `place`: most first, of equal counts the kind seen first."""
    kinds = sources.groupBy("strategy").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    return kinds.select("strategy", "n", F.row_number().over(Window.orderBy(F.desc("n"), "first")).alias("place")).orderBy("place")  # one row a kind


def grouped(sources: DataFrame, *by: str) -> DataFrame:
    """Sources listed under one or two levels, in the catalogue's order, nulls last."""
    lists = sources.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))
    return lists.orderBy(*(F.asc_nulls_last(c) for c in by))


def by_category(sources: DataFrame, categories: DataFrame) -> DataFrame:
    """The same under the categories, in their own order, sources without one last."""
    place = categories.groupBy(F.col("id").alias("_c")).agg(F.min("pos").alias("_p"))
    lists = grouped(sources, "appCategory").join(place, F.col("appCategory") == F.col("_c"), "left")
    return lists.orderBy(F.asc_nulls_last("_p")).select("appCategory", "n", "names")


def coverage(sources: DataFrame) -> DataFrame:
    """Totals for the head of the coverage report."""
    on = F.col("crawlAvailable") & F.col("crawlEnabled")
    return sources.agg(F.count(F.lit(1)).alias("total"), F.count_if(on).alias("enabled"), F.count_distinct("strategy").alias("strategies"))


def markdown_table(rows: DataFrame, order: list[Column]) -> DataFrame:
    """A DataFrame as the lines of a Markdown table: `pos`, `text`."""
    cell = lambda c: F.array_join(F.col(c), ", ") if dict(rows.dtypes)[c].startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("-"))
    body = rows.select((F.row_number().over(Window.orderBy(*order)) + 1).alias("pos"), F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, rows.columns)), F.lit(" |")).alias("text"))
    head = rows.sparkSession.createDataFrame([(0, "| " + " | ".join(rows.columns) + " |"), (1, "| " + " | ".join(["---"] * len(rows.columns)) + " |")], "pos int, text string")
    return head.unionByName(body)


def _report(rows: DataFrame, title: str, head: list[str], cells: list[Column], tail: list[str] | None = None) -> DataFrame:
    """Lines of a report: a heading and a table for each section. `rows`: `_order` and `_section` of each source, and `pos`."""
    spark = rows.sparkSession
    line = lambda n, text: F.struct(F.lit(n).cast("long").alias("n"), text.alias("text"))
    width = "| " + " | ".join(["---"] * len(head)) + " |"
    section = rows.select("_order", "_section").distinct()
    opening = section.select("_order", F.explode(F.array(
        line(-5, F.concat(F.lit("## "), F.col("_section"))), line(-4, F.lit("")), line(-3, F.lit("| " + " | ".join(head) + " |")), line(-2, F.lit(width)), line(2**40, F.lit("")))).alias("x"))
    body = rows.select("_order", line(0, F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(c, F.lit("")) for c in cells)), F.lit(" |"))).withField("n", F.col("pos").cast("long")).alias("x"))
    lines = opening.unionByName(body).select("_order", "x.n", "x.text")
    before = [("0", i, t) for i, t in enumerate([f"# {title}", "", ""])]
    after = [("9", i, t) for i, t in enumerate(tail or [])]
    ends = spark.createDataFrame(before + after, "_order string, n long, text string")
    order = F.row_number().over(Window.orderBy("_order", "n"))  # as many rows as the catalogue
    return lines.unionByName(ends).select(order.alias("pos"), "text")


def _cells(sources: DataFrame) -> dict[str, Column]:
    code = lambda c: F.concat(F.lit("`"), F.col(c), F.lit("`"))
    on = F.when(F.coalesce(F.col("crawlAvailable") & F.col("crawlEnabled"), F.lit(False)), F.lit("O"))
    return {"id": code("id"), "name": F.col("name"), "campus": F.col("campus"), "strategy": F.when(F.col("strategy") != "standard", F.col("strategy")), "enabled": on}


def college_report(sources: DataFrame) -> DataFrame:
    """Sources under their colleges by name, those without one last, as lines of a Markdown document (`pos`, `text`)."""
    rows = sources.withColumns({"_order": F.concat(F.when(F.col("college").isNull(), "2").otherwise("1"), F.coalesce("college", F.lit(""))), "_section": F.coalesce("college", F.lit("without a college"))})
    return _report(rows, "Sources by college", ["id", "name", "campus", "strategy", "enabled"], list(_cells(sources).values()))


def category_report(sources: DataFrame, categories: DataFrame) -> DataFrame:
    """Sources under the categories in these' order, those without one last; sources of unknown categories are left out."""
    place = categories.select(F.col("id").alias("_c"), F.col("pos").alias("_p"), F.concat(F.coalesce("label.en", F.lit("")), F.lit(" ("), F.col("id"), F.lit(")")).alias("_label"))
    j = sources.join(place, F.col("appCategory") == F.col("_c"), "left").where(F.col("appCategory").isNull() | F.col("_c").isNotNull())
    rows = j.withColumns({"_order": F.when(F.col("_c").isNull(), "2").otherwise(F.concat(F.lit("1"), F.lpad(F.col("_p").cast("string"), 9, "0"))), "_section": F.coalesce("_label", F.lit("without a category"))})
    return _report(rows, "Sources by category", ["id", "name", "campus", "strategy", "enabled"], list(_cells(sources).values()))


def coverage_report(sources: DataFrame) -> DataFrame:
    """Sources under campus and college (or category, where both campuses share them), with totals at the end."""
    c = coverage(sources).first()  # one row
    within = F.when(F.col("campus") == "both", F.coalesce("appCategory", F.lit("-"))).otherwise(F.coalesce("college", F.lit("-")))
    first = F.min("pos").over(Window.partitionBy("campus", "_within"))
    rows = sources.withColumn("_within", within).withColumn("_first", first)
    place = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in (("hssc", "1"), ("nsc", "2"), ("both", "3")) for x in p)), F.col("campus")), F.lit("4"))
    rows = rows.withColumns({"_order": F.concat(place, F.lpad(F.col("_first").cast("string"), 9, "0")), "_section": F.concat_ws(" / ", F.coalesce("campus", F.lit("no campus")), "_within")})
    cells = _cells(sources)
    tail = [f"- entries: {c['total']}", f"- enabled: {c['enabled']}", f"- kinds of boards: {c['strategies']}"]
    return _report(rows, "Coverage", ["id", "name", "strategy", "enabled"], [cells[k] for k in ("id", "name", "strategy", "enabled")], tail)


def write_text(lines: DataFrame, path: str) -> None:
    """An artifact as one text file; artifacts are as long as the catalogue."""
    lines.coalesce(1).sortWithinPartitions("pos").select("text").write.mode("overwrite").text(path)
