"""Quality rules with cross-document line frequency. DataFrame functions only.

Each text is measured in place with array functions. Its lines are normalised and hashed with their host; the number of
distinct documents of each (host, line) is counted with map-side sums; lines above the limit are removed, and a document
that loses too much of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import BROADCAST_ROWS, HOT_KEYS, WORD, cut, free_name, let

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LINE_DOCS = 50  # documents of one host that may share a line
LEAST_LEFT = 30  # percent of its words that a document must keep
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words that may lie in repeated windows


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Windows are hashed and sorted with their places; neighbours with equal hashes are repeats; the places of repeats,
    sorted, cover three words each, or as many as lie before the next place.
    """

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeats(s: Column) -> Column:
        same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
        again = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
        return let(F.sort_array(F.transform(again, lambda x: x["p"])), covered)

    def windows(w: Column) -> Column:
        hashed = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))
        return let(F.sort_array(hashed), repeats)

    return let(words, windows)


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, SPACES, "")) > 0


def normalised(line: Column) -> Column:
    """A line without case and outer spaces, runs of spaces as one, numbers as 0."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.btrim(line, F.lit(SPACES))), r"[ \t\x0b\f\r]+", " "), "[0-9]+", "0")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The base measures of one text, given with its words; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), _has_word)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(words),
    }


def _line_keys(text: Column, host: Column) -> Column:
    """Key (64-bit hash of host and normalised line) and number of words of each line with a word."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), normalised), lambda x: x != "")
    n_words = lambda x: F.length(x) - F.length(F.translate(x, " ", "")) + 1  # noqa: E731  one space between words is left
    return F.transform(lines, lambda x: F.struct(F.xxhash64(host, x).alias("k"), n_words(x).alias("w")))


def judge(docs: DataFrame, *, text: str = "text", host: str = "source", line_docs: int = LINE_DOCS) -> DataFrame:
    """One row for each different (doc_id, host, text), by `_key`: base measures, words in too frequent lines, their keys.

    Texts are read once; what follows works on the written narrow table. A hot line is counted by map-side sums and looked
    up by broadcast, so no task gets all its documents.
    """
    key = F.xxhash64("doc_id", host, text)
    read = docs.select("doc_id", host, text, _words(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
    narrow = read.select("doc_id", key.alias("_key"), *(c.alias(n) for n, c in measures(F.col(text), F.col("_words")).items()), _line_keys(F.col(text), F.col(host)).alias("_lines"))
    narrow = cut(narrow).dropDuplicates(["doc_id", "_key"])
    narrow = cut(narrow)
    each = narrow.select("doc_id", "_key", F.explode("_lines").alias("x")).select("doc_id", "_key", "x.k", "x.w")
    counted = narrow.select(F.explode(F.array_distinct(F.transform("_lines", lambda x: x["k"]))).alias("k")).groupBy("k").count()
    hit = _hit(each, cut(counted.where(F.col("count") > line_docs).select(F.col("k").alias("_f"), "count")))
    lost = hit.groupBy(F.col("_key").alias("_lk"), F.col("doc_id").alias("_ld")).agg(F.sum("w").alias("n_removed_words"), F.collect_set("k").alias("_bad"))
    joined = narrow.drop("_lines").join(lost, (F.col("_key") == F.col("_lk")) & F.col("doc_id").eqNullSafe(F.col("_ld")), "left").drop("_lk", "_ld")
    return joined.withColumns({"n_removed_words": F.coalesce("n_removed_words", F.lit(0)).cast("long"), "_bad": F.coalesce("_bad", F.array().cast("array<bigint>"))})


def _hit(each: DataFrame, frequent: DataFrame) -> DataFrame:
    """Lines that are frequent. Few frequent lines are broadcast; of many those that have a great part of all, which are few, and the others meet by shuffle."""
    if frequent.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return each.join(F.broadcast(frequent), F.col("k") == F.col("_f")).drop("_f", "count")
    most = max(1000, (frequent.agg(F.sum("count")).first()[0] or 0) // HOT_KEYS)
    hot, rest = F.broadcast(frequent.where(F.col("count") > most)), frequent.where(F.col("count") <= most)
    on = F.col("k") == F.col("_f")
    return each.join(hot, on).drop("_f", "count").unionByName(each.join(hot, on, "left_anti").join(rest, on).drop("_f", "count"))


def _verdicts(docs: DataFrame, text: str, host: str, line_docs: int, least_left: int) -> tuple[DataFrame, dict[str, Column]]:
    """`docs` joined to what `judge` says of each row, and the columns of the verdict."""
    key, told = free_name("_key", docs), free_name("_told", docs)
    v = judge(docs.select("doc_id", host, text), text=text, host=host, line_docs=line_docs)
    v = v.select(F.struct(*v.columns).alias(told))
    joined = docs.withColumn(key, F.xxhash64("doc_id", host, text)).join(v, (F.col(key) == F.col(f"{told}._key")) & F.col("doc_id").eqNullSafe(F.col(f"{told}.doc_id")))
    m = {n: F.col(f"{told}.{n}") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words")}
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
    kept = ~failed & (100 * (m["n_words"] - m["n_removed_words"]) >= least_left * m["n_words"])
    removed = m.pop("n_removed_words")
    return joined, m | {"base_failed": failed, "kept": kept, "n_removed_words": removed, "_bad": F.col(f"{told}._bad")}


def apply_rules(docs: DataFrame, *, text: str = "text", host: str = "source", line_docs: int = LINE_DOCS, least_left: int = LEAST_LEFT) -> DataFrame:
    """`docs` with `rules`: the base measures, base_failed, n_removed_words, kept, and the text without removed lines.

    Base: fails below 50 words, or if over half of the words lie in repeated 3-word windows. Method: lines found in more
    than `line_docs` documents of a host are removed (hosts and lines compared by a 64-bit hash; equal rows count as one
    document; a null host is a host); a document left with under `least_left` percent of its words is not kept. A null
    text counts as empty; texts are measured whole, however long, each by one task; equal rows get equal verdicts; an empty
    table stays empty; a column called `rules` is replaced and all others are kept.
    """
    kept_columns = [c for c in docs.columns if c != "rules"]
    joined, m = _verdicts(docs.select(*kept_columns), text, host, line_docs, least_left)
    bad = m.pop("_bad")
    left = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: ~(_has_word(x) & F.array_contains(bad, F.xxhash64(F.col(host), normalised(x)))))
    return joined.select(*kept_columns, F.struct(*(c.alias(n) for n, c in m.items()), F.array_join(left, "\n").alias("text")).alias("rules"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op6; texts stay where they are read."""
    joined, m = _verdicts(docs.select("doc_id", "source", "text"), "text", "source", LINE_DOCS, LEAST_LEFT)
    m.pop("_bad")
    return joined.select("doc_id", *(c.alias(n) for n, c in m.items()))
