"""A fact roll-up that follows the fact's changes instead of being computed anew.

Sums and counts are additive: a load's inserted rows add to the totals of their levels,
removed rows take away, and a corrected row does both. Each load is added up by level
(partial sums in every task) and appended, under a commit log, as signed totals; the
roll-up adds the loads' totals and expands the result to its grouping sets. So a load
costs what it brings, not what the fact holds, and one that is tried twice counts once.
Now and then ``compact`` writes the sum of all loads as one, which then stands for them.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators.history import rollup_levels
from starweave.sources.commit_log import EntryLog


class RollupStore:
    """The roll-up in the folder ``path``: ``levels`` (DDL, from the widest to the finest), additive measures ``sums``."""

    def __init__(self, spark: SparkSession, path: str, levels: str, sums: Sequence[str], count_name: str = "fact_rows"):
        self.spark, self.path, self.log = spark, path.rstrip("/"), EntryLog(spark, path)
        self.level_fields, self.sums, self.count_name = T.StructType.fromDDL(levels).fields, list(sums), count_name
        self.levels = [f.name for f in self.level_fields]
        self.schema = T.StructType([*self.level_fields, *[T.StructField(m, T.LongType()) for m in [*self.sums, count_name]]])

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        levels = [F.col(f.name).cast(f.dataType) for f in self.level_fields]
        return rows.select(*levels, *[(F.lit(sign) * F.col(m)).cast("bigint").alias(m) for m in self.sums], F.lit(sign).cast("bigint").alias(self.count_name))

    def _added_up(self, rows: DataFrame) -> DataFrame:
        # a measure that is null in all rows of a level stays null in a plain sum; here it counts as 0
        return rows.groupBy(*self.levels).agg(*[F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in [*self.sums, self.count_name]])

    def _write(self, totals: DataFrame) -> str:
        attempt = f"a{os.urandom(8).hex()}"
        totals.select(*self.schema.names).write.parquet(f"{self.path}/data/{attempt}")
        return attempt

    def _read(self, entries: Sequence[dict]) -> DataFrame:
        """The signed totals of the loads; those before the last compaction are in it."""
        whole = max((i for i, e in enumerate(entries) if e["whole"]), default=0)
        paths = [f"{self.path}/data/{e['attempt']}" for e in entries[whole:]]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def apply(self, load_id: str, added: DataFrame | None = None, removed: DataFrame | None = None) -> bool:
        """Counts fact rows (with their levels and measures) in and out; False if the load had been applied before."""
        known = lambda: any(e["load_id"] == load_id for e in self.log.entries())
        parts = [self._signed(rows, sign) for rows, sign in ((added, 1), (removed, -1)) if rows is not None]
        if not parts:
            raise ValueError("a load adds or removes rows")
        if known():
            return False
        attempt = self._write(self._added_up(reduce(DataFrame.unionByName, parts)))
        while not known():  # totals do not depend on other loads: a writer that came first is no reason to start again
            if self.log.put(len(self.log.entries()), {"load_id": load_id, "attempt": attempt, "whole": False}):
                return True
        return False

    def compact(self) -> bool:
        """Writes the totals as one entry that stands for all before it; False if a load has come between."""
        done = self.log.entries()
        attempt = self._write(self._live(done))
        return self.log.put(len(done), {"load_id": f"compact-{attempt}", "attempt": attempt, "whole": True})

    def _live(self, entries: Sequence[dict]) -> DataFrame:
        totals = self._added_up(self._read(entries))
        some = F.lit(False)
        for m in [*self.sums, self.count_name]:
            some = some | (F.col(m) != 0)
        return totals.filter(some)

    def totals(self) -> DataFrame:
        """One row for each combination of levels that rows are left of."""
        return self._live(self.log.entries())

    def rollup(self) -> DataFrame:
        """The columns of ``history.rollup_fact``."""
        return rollup_levels(self.totals(), self.levels, self.sums, self.count_name)
