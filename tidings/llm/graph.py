"""Connected components of a large graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import cut

SMALL = 1_000_000  # edges, counted, that one task finishes (16 bytes each)


def _roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The least node that each node of a small graph is connected with."""
    parts = list(batches)
    if not parts:
        return
    a, b = (np.concatenate([p[c].to_numpy(dtype=np.int64) for p in parts]) for c in ("a", "b"))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, least = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        before = least.copy()
        np.minimum.at(least, least[x], least[y])
        np.minimum.at(least, least[y], least[x])
        while (further := least[least]).tolist() != least.tolist():
            least = further
        if (least == before).all():
            break
    yield pd.DataFrame({"v": nodes, "to": nodes[least]})


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); a component is named by its least node.

    Each round every node points to its least neighbour or itself; pointers are followed to their ends, by doubling. The
    graph is then contracted: ends of edges are replaced by what they point to, and edges within one node and repeated
    ones go. So the nodes that edges still join at least halve from round to round. Once no more than SMALL edges are
    left, one task finishes. A node with very many neighbours is only a key of partial minima. Each step is written to the
    checkpoint folder.
    """
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    left = cut(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    names = left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).unionByName(loops).distinct()
    names = cut(names.withColumn("component", F.col("node")))
    while left.count() > SMALL:
        # (a, b) has a < b: every end b may point to a, every end a to itself
        points = cut(left.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("to")))
        while True:
            far = points.select(F.col("v").alias("_v"), F.col("to").alias("_far"))
            jumped = cut(points.join(far, F.col("to") == F.col("_v"), "left").select("v", F.coalesce("_far", "to").alias("to"), F.col("_far").isNotNull().alias("moved")))
            points = jumped.drop("moved")
            if not jumped.where("moved").limit(1).count():
                break
        names = cut(_renamed(names, points))
        pa, pb = points.select(F.col("v").alias("_a"), F.col("to").alias("_ta")), points.select(F.col("v").alias("_b"), F.col("to").alias("_tb"))
        moved = left.join(pb, F.col("b") == F.col("_b")).join(pa, F.col("a") == F.col("_a"), "left").select(F.coalesce("_ta", "a").alias("a"), F.col("_tb").alias("b"))
        left = cut(moved.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return cut(_renamed(names, left.repartition(1).mapInPandas(_roots, "v long, to long")))


def _renamed(names: DataFrame, points: DataFrame) -> DataFrame:
    return names.join(points, F.col("component") == F.col("v"), "left").select("node", F.coalesce("to", "component").alias("component"))
