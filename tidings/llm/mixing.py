"""Mixing sources to target weights by hash-threshold histograms. DataFrame functions only.

Each source gets a budget of words. A document's place is a hash of its row, so a budget becomes a threshold on that
hash: sum the words by source and leading hash digit, find the digit in which the running sum passes the budget, and
split only that digit further. Nothing is sorted, and one pass over the narrow table serves all sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidings.llm.common import cut, free_name, join_small, n_words

DIGIT = 10  # bits a level
LEVELS = 6  # of a 63-bit hash


def place(doc_id: Column, text: Column) -> Column:
    """63-bit place of a row; equal rows share it."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 1)


def source_weights(sizes: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """Add `weight`: the cycle's values dealt to the sources by code point, null last.

    The sources are range-partitioned and numbered in place, so they never meet in one task; only one count for each
    partition reaches the driver.
    """
    spark = sizes.sparkSession
    parts = min(64, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    order = (F.col("source").isNull(), F.col("source"))
    placed = sizes.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = cut(placed)
    part = F.shiftright("_at", 33)
    ahead, offsets = 0, []
    for r in sorted(placed.groupBy(part.alias("p")).count().collect()):
        offsets += [F.lit(r["p"]), F.lit(ahead)]
        ahead += r["count"]
    if not offsets:
        return placed.drop("_at").withColumn("weight", F.lit(0.0))
    rank = F.element_at(F.create_map(*offsets), part) + F.col("_at").bitwiseAND((1 << 33) - 1)
    weights = F.array(*(F.lit(float(w)) for w in cycle))
    return placed.withColumn("weight", F.element_at(weights, (F.pmod(rank, F.lit(len(cycle))) + 1).cast("int"))).drop("_at")


def source_targets(sizes: DataFrame, cycle: tuple[float, ...], repeat_limit: int) -> DataFrame:
    """Add `target`: shares of all words by weight, none above `repeat_limit` times its source, the rest reshared."""
    w = cut(source_weights(sizes, cycle))
    most = F.col("source_size") * F.lit(float(repeat_limit))
    level, n_full = 0.0, -1
    while True:
        over = most <= F.col("weight") * F.lit(level) if n_full >= 0 else F.lit(False)
        r = w.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(over, most)).alias("full"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight"), F.count_if(over).alias("n"),
        ).first()
        if not r["weight"] or r["n"] == n_full:
            break
        n_full, level = r["n"], (r["all"] - (r["full"] or 0.0)) / r["weight"]
    return w.withColumn("target", F.least(most, F.col("weight") * F.lit(float(level))).cast("double"))


def mix_plan(docs: DataFrame, *, cycle: tuple[float, ...] = (5, 2, 1), repeat_limit: int = 3) -> DataFrame:
    """For each source its size, target, whole copies of each document and the threshold for one copy more."""
    rows = cut(docs.select("source", n_words(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("at")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    plan = source_targets(sizes, cycle, repeat_limit).withColumn("copies", whole)
    plan = plan.select(
        "source", "source_size", "target", "copies", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"), F.col("source_size").alias("inside"),
    )
    plan = cut(plan)
    for level in range(1, LEVELS + 1):
        shift = 63 - DIGIT * level
        budget = plan.select(F.col("source").alias("_s"), "rest", "prefix", "below")
        inside = join_small(rows, budget, F.col("source").eqNullSafe(F.col("_s")), "inner")
        inside = inside.where(F.shiftright("at", shift + DIGIT) == F.col("prefix")) if level > 1 else inside
        histogram = inside.groupBy("_s", "rest", "below", F.shiftright("at", shift).alias("_p")).agg(
            F.sum("size").alias("_size"), F.count(F.lit(1)).alias("_n"))
        up_to = F.col("below") + F.sum("_size").over(Window.partitionBy("_s").orderBy("_p"))
        bounds = (
            histogram.withColumn("_to", up_to)
            .where((F.col("_to") > F.col("rest")) & (F.col("_to") - F.col("_size") <= F.col("rest")))
            .select(F.col("_s").alias("_b"), "_p", (F.col("_to") - F.col("_size")).alias("_below"), F.col("_size").alias("_in"), "_n")
        )
        found = join_small(plan.drop("_n"), cut(bounds), F.col("source").eqNullSafe(F.col("_b")), "left")
        plan = cut(found.select(
            "source", "source_size", "target", "copies", "rest", F.coalesce("_p", F.lit(0)).alias("prefix"),
            F.coalesce("_below", F.lit(0)).alias("below"), F.coalesce("_in", F.lit(0)).alias("inside"), F.lit(shift).alias("shift"),
            F.coalesce("_n", F.lit(0)).alias("_n"),
        ))
        if (plan.agg(F.max("_n")).first()[0] or 0) <= 1:
            break
    nearer = F.col("below") + F.col("inside") - F.col("rest") < F.col("rest") - F.col("below")
    return plan.select("source", "source_size", "target", "copies", "prefix", "shift", nearer.alias("with_bound"))


def mix_sources(docs: DataFrame, *, cycle: tuple[float, ...] = (5, 2, 1), repeat_limit: int = 3) -> DataFrame:
    """All rows of `docs` with how often the mix takes each.

    Sources by code point, null last, get the weights of `cycle`, repeating, as shares of all words; a target stops at
    `repeat_limit` times its source's words. A source takes every document `copies` times, and one time more those whose
    hash lies below its threshold. Columns added: `mix_size` (words), `mix_source_size`, `mix_target`, `mix_copies`;
    columns of those names in the input are replaced, all others stay. A null text has no words; sources without words
    have target 0; equal rows get equal copies; a very long text counts whole, and is taken or not as one; an empty table
    gives an empty one.
    """
    x, at = free_name("_mix", docs), free_name("_place", docs)
    plan = mix_plan(docs, cycle=cycle, repeat_limit=repeat_limit)
    plan = plan.select(F.struct(*plan.columns).alias(x))
    rows = docs.withColumns({"mix_size": n_words(F.col("text")), at: place(F.col("doc_id"), F.col("text"))})
    joined = join_small(rows, plan, F.col("source").eqNullSafe(F.col(f"{x}.source")), "inner")
    digits, prefix, copies = F.expr(f"shiftright(`{at}`, `{x}`.shift)"), F.col(f"{x}.prefix"), F.col(f"{x}.copies")
    once_more = (digits < prefix) | ((digits == prefix) & F.col(f"{x}.with_bound"))
    out = joined.withColumns({
        "mix_source_size": F.col(f"{x}.source_size"), "mix_target": F.col(f"{x}.target"),
        "mix_copies": (copies + F.when(once_more & (copies < repeat_limit), 1).otherwise(0)).cast("int"),
    })
    return out.drop(x, at)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op5: what the mix takes of each document."""
    return mix_sources(docs.select("doc_id", "source", "text")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"))
