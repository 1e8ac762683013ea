"""A type-2 dimension of which a merge rewrites only the buckets that change.

The rows lie in ``buckets`` folders by the hash of their natural key. A merge reads the
buckets that incoming keys fall in, finds those that hold a changed or a new member, and
writes these anew under a fresh attempt; one manifest entry then points the bucket numbers
at their new folders. All other files stay as they are, under the same names. Readers see
the manifest that was there when they looked, so they never meet half a merge; old folders
stay until somebody removes them, and so do the results of readers.

The entry also names the largest surrogate key so far. A load id counts once, and of two
writers the second computes its merge again from what the first has made.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators.history import scd2_merge
from starweave.sources.commit_log import EntryLog
from starweave.sources.files import materialize

BUCKET, ATTEMPT = "_sw_bucket", "_sw_attempt"


class BucketedDimension:
    """The dimension in the folder ``path``: columns ``schema`` with ``tk``, version, date_from, date_to, ``keys`` and ``attrs``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], attrs: Sequence[str], tk: str, buckets: int = 64):
        self.spark, self.path, self.log = spark, path.rstrip("/"), EntryLog(spark, path)
        self.schema, self.keys, self.attrs, self.tk, self.buckets = schema, list(keys), list(attrs), tk, buckets

    def _bucketed(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in self.schema.fields}
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast(types[k]) for k in self.keys]), F.lit(self.buckets)).cast("int"))

    def manifest(self) -> dict[int, str]:
        """Bucket -> attempt that holds its rows; buckets without rows are missing."""
        out: dict[int, str] = {}
        for e in self.log.entries():
            if e["buckets"] != self.buckets:
                raise ValueError(f"the dimension was made with {e['buckets']} buckets")
            out |= {b: e["attempt"] for b in e["written"]}
        return out

    def _read(self, manifest: dict[int, str]) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField(ATTEMPT, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        paths = [f"{self.path}/data/{ATTEMPT}={a}/{BUCKET}={b}" for b, a in sorted(manifest.items())]
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths) if paths else self.spark.createDataFrame([], full)
        return rows.drop(ATTEMPT)

    def table(self) -> DataFrame:
        """The dimension as of the last entry."""
        return self._read(self.manifest()).select(*self.schema.names)

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """Writes buckets to a fresh attempt: (attempt, bucket numbers written)."""
        attempt = f"a{os.urandom(8).hex()}"
        self._bucketed(rows).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{ATTEMPT}={attempt}")
        folder, fs = self.log.java_path(f"data/{ATTEMPT}={attempt}")
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return attempt, sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))

    def _commit(self, number: int, load_id: str, rows: DataFrame | None, top: int) -> bool:
        attempt, written = self._write(rows) if rows is not None else ("", [])
        if rows is not None:
            top = max(top, self._read({b: attempt for b in written}).agg(F.max(self.tk)).first()[0] or 0)
        return self.log.put(number, {"load_id": load_id, "attempt": attempt, "buckets": self.buckets, "written": written, "top": top})

    def create(self, load_id: str, rows: DataFrame) -> None:
        """The first rows, as a dimension build makes them; nothing happens if there are any."""
        while not self.log.entries() and not self._commit(0, load_id, rows.select(*self.schema.names), 0):
            pass

    def merge(self, load_id: str, incoming: DataFrame, load_ts: datetime | str) -> list[int]:
        """``history.scd2_merge`` of ``incoming`` (one row per natural key); returns the buckets rewritten, none if the load was merged before."""
        inc = materialize(self._bucketed(incoming.select(*self.keys, *self.attrs)), "bucketed-incoming")
        coming = {r[0] for r in inc.select(BUCKET).distinct().collect()}  # at most ``buckets`` numbers
        while True:
            done = self.log.entries()
            if any(e["load_id"] == load_id for e in done):
                return []
            manifest, top = self.manifest(), max((e["top"] for e in done), default=0)
            touched = self._touched(self._read({b: a for b, a in manifest.items() if b in coming}), inc)
            if not touched:
                rows = None
            else:
                current = self._read({b: a for b, a in manifest.items() if b in touched}).select(*self.schema.names)
                mine = inc.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
                rows = scd2_merge(current, mine, self.keys, self.attrs, self.tk, load_ts, top=top)
            if self._commit(len(done), load_id, rows, top):
                return touched

    def _touched(self, current: DataFrame, inc: DataFrame) -> list[int]:
        """Buckets with a changed or a new member: at most ``buckets`` numbers."""
        opened = current.where(F.col("date_to").isNull() & (F.col(self.tk) != 0))
        opened = opened.select(F.lit(True).alias("_sw_there"), *[F.col(c).alias(f"_sw_cur_{c}") for c in [BUCKET, *self.keys, *self.attrs]])
        cond = [inc[BUCKET] == opened[f"_sw_cur_{BUCKET}"], *[inc[k].eqNullSafe(opened[f"_sw_cur_{k}"]) for k in self.keys]]
        same = F.col("_sw_there").isNotNull()
        for a in self.attrs:
            same = same & F.col(a).eqNullSafe(F.col(f"_sw_cur_{a}"))
        return sorted(r[0] for r in inc.join(opened, cond, "left").where(~same).select(BUCKET).distinct().collect())
