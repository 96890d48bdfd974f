"""The notice table in buckets: a merge rewrites the buckets it touches, a scan reads the buckets it needs.

Rows lie below `_sb=<hash of the source>/_kb=<hash of the number>`, so that one source is a few folders and a very large one
is still split. Which buckets a set of keys touches is a small table, bounded by the number of buckets; it is broadcast and
prunes the scan while it runs (dynamic partition pruning).

A merge first writes the touched buckets, whole, beside the table, marks that copy as ready, and then overwrites these buckets
of the table from it, which can be done again with the same result. Whatever died half-way is therefore finished by the
next writer, and a merge that is repeated under the same tag isn't applied twice. One writer a table at a time. A plan made
before a merge and run after it may find files gone, and fails rather than mixes: read the table again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.schemas import NOTICE
from tidings.session import shared_dir, small, written

SB, KB = "_sb", "_kb"
BUCKETS = (64, 4)  # by source, by number
KEY_BUCKETS = 64


def bucket(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def in_buckets(table: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the buckets in `touched`, whose columns are bucket columns: no more rows than there are buckets, so it is broadcast.

    The comparison says nothing new; it marks the small side as one that selects, without which Spark prunes no partitions.
    """
    names = touched.columns
    chosen = touched.where(F.greatest(*(F.col(c) for c in names), F.lit(-1)) >= 0).distinct()
    return table.join(F.broadcast(chosen), names, "left_semi")


class Buckets:
    """A table of notices below `path`; `buckets` counts when the table is made, and is read from it later on."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = NOTICE, buckets: tuple[int, int] = BUCKETS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        found = self._row("layout", "sources int, numbers int")
        self.buckets = tuple(found) if found else buckets
        self.whole = T.StructType([*schema.fields, T.StructField(SB, T.IntegerType()), T.StructField(KB, T.IntegerType())])

    def _row(self, name: str, schema: str):
        """The one row of a small table, or None where it is not there, or was not finished."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _note(self, name: str, schema: str, row: tuple) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{name}")

    def _mark(self, name: str) -> tuple[int, str | None]:
        row = self._row(name, "n long, tag string")
        return (row["n"], row["tag"]) if row else (0, None)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({SB: bucket("sourceId", self.buckets[0]), KB: bucket("articleNo", self.buckets[1])})

    def _table(self, name: str = "data") -> DataFrame:
        try:
            return self.spark.read.schema(self.whole).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.whole)

    def read(self) -> DataFrame:
        return self._table().select(*self.schema.names)

    def of_keys(self, keys: DataFrame) -> DataFrame:
        """All rows of the buckets that the keys (sourceId, articleNo) fall into."""
        return in_buckets(self._table(), self._keyed(keys.select("sourceId", "articleNo")).select(SB, KB)).select(*self.schema.names)

    def of_sources(self, sources: DataFrame) -> DataFrame:
        """The rows of the sources (`id`)."""
        ids = sources.select(F.col("id").alias("sourceId")).distinct()
        rows = in_buckets(self._table(), ids.select(bucket("sourceId", self.buckets[0]).alias(SB)))
        return rows.join(small(ids), "sourceId", "left_semi").select(*self.schema.names)

    def merge(self, changes: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], tag: str | None = None) -> int:
        """Rewrite the buckets that the changes (by sourceId and articleNo) touch; how many these are.

        `apply(state, changes)` gives the new rows of these buckets from the old ones; it must keep rows that no change concerns.
        """
        self.recover()
        n, last = self._mark("done")
        if tag is not None and tag == last:
            return 0
        changes = written(changes)
        if not changes.limit(1).count():
            return 0
        return self._publish(self._staged(n + 1, tag, apply(self.of_keys(changes), changes)))

    def write(self, state: DataFrame) -> int:
        """Merge rows that replace those of the same keys, or are new."""

        def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
            return old.join(new.select("sourceId", "articleNo"), ["sourceId", "articleNo"], "left_anti").select(*self.schema.names).unionByName(new)

        return self.merge(state.select(*(F.col(f.name).cast(f.dataType) for f in self.schema)), replaced)

    def recover(self) -> bool:
        """Finish what a writer that died had made ready: was there anything?"""
        (ready, tag), (done, _) = self._mark("ready"), self._mark("done")
        if ready > done:
            self._publish((ready, tag))
        return ready > done

    def _staged(self, n: int, tag: str | None, rows: DataFrame) -> tuple[int, str | None]:
        if n == 1:
            self._note("layout", "sources int, numbers int", self.buckets)
        rows = self._keyed(rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema)))
        # about equal files: small buckets share a task, a large one is split
        rows = rows.hint("rebalance", SB, KB).sortWithinPartitions(SB, KB, "sourceId", F.desc("date"))
        rows.write.mode("overwrite").partitionBy(SB, KB).parquet(f"{self.path}/staged/{n % 2}")
        self._note("ready", "n long, tag string", (n, tag))
        return n, tag

    def _publish(self, ready: tuple[int, str | None]) -> int:
        rows = self._table(f"staged/{ready[0] % 2}")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SB, KB).parquet(f"{self.path}/data")
        self._note("done", "n long, tag string", ready)
        return rows.select(SB, KB).distinct().count()


def keys_by_source(rows: DataFrame, n: int = KEY_BUCKETS) -> DataFrame:
    """The keys of the rows, written by source, so that later scans read those of some sources only."""
    spark, at = rows.sparkSession, shared_dir(rows.sparkSession)
    keys = rows.select("sourceId", "articleNo").withColumn(SB, bucket("sourceId", n))
    keys.hint("rebalance", SB).write.partitionBy(SB).parquet(at)
    return spark.read.schema(keys.schema).parquet(at)


def of_sources(keys: DataFrame, sources: DataFrame, n: int = KEY_BUCKETS) -> DataFrame:
    """Those of the written keys whose source is among `sources` (`id`)."""
    ids = sources.select(F.col("id").alias("sourceId")).distinct()
    rows = in_buckets(keys, ids.select(bucket("sourceId", n).alias(SB)))
    return rows.join(small(ids), "sourceId", "left_semi").select("sourceId", "articleNo")
