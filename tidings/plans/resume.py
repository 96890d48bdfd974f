"""Long backfills in units that a restart does not repeat.

The keys are dealt to a number of units by a hash; each unit is worked on and written by itself, and has a mark, written
last. Whoever starts again with the same folder does the units without a mark, under the same division.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.schemas import KEY

UNITS = 16


class Units:
    """The units of a backfill whose progress is kept in the folder `at`; `n` counts when it begins."""

    def __init__(self, spark: SparkSession, at: str, n: int = UNITS):
        self.spark, self.at = spark, at.rstrip("/")
        marks = self._marks()
        self.n = marks[0][1] if marks else n

    def _marks(self) -> list[tuple[int, int]]:
        """Finished units, with the number of units that there are."""
        try:
            marks = self.spark.read.schema("unit int, of int").option("recursiveFileLookup", "true").parquet(f"{self.at}/done")
            return sorted((r["unit"], r["of"]) for r in marks.distinct().collect())  # no more than there are units
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def left(self) -> list[int]:
        done = {unit for unit, _ in self._marks()}
        return [k for k in range(self.n) if k not in done]

    def part(self, rows: DataFrame, unit: int) -> DataFrame:
        """The rows of a unit, by their key."""
        return rows.where(F.pmod(F.xxhash64(F.lit(17), *KEY), F.lit(self.n)) == unit)

    def finish(self, unit: int) -> None:
        self.spark.createDataFrame([(unit, self.n)], "unit int, of int").coalesce(1).write.mode("overwrite").parquet(f"{self.at}/done/unit={unit}")

    def run(self, rows: DataFrame | Callable[[], DataFrame], work: Callable[[DataFrame], DataFrame | None]) -> int:
        """Do what is left; how many units that were. What `work` gives for a unit is written as that unit's rows, if it gives any.

        Where the work changes the table that the rows come from, `rows` is a function that reads them anew for each unit.
        """
        todo = self.left()
        for unit in todo:
            out = work(self.part(rows() if callable(rows) else rows, unit))
            if out is not None:
                out.write.mode("overwrite").parquet(f"{self.at}/rows/unit={unit}")
            self.finish(unit)
        return len(todo)

    def results(self) -> DataFrame:
        """The rows of all finished units."""
        done = {unit for unit, _ in self._marks()}
        return self.spark.read.parquet(*(f"{self.at}/rows/unit={k}" for k in sorted(done)))
