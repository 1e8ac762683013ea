"""Append-only tables whose loads count once: attempt folders and a log of commits.

A load writes its rows to a folder of its own (an attempt), then one log entry makes the
attempt part of the table. The entry is a small file with the next free number, made
complete under another name and put in place by an operation that fails if the number is
taken. So

- a job that dies before that leaves a folder nobody reads;
- a load that comes again (same load id) finds its entry and adds nothing;
- of two writers one gets the number; the other sees the entry and goes on behind it.

An entry also reserves the load's range of ids: rows are written with their place in the
load only, and a row's id is the first id of its load plus its place, so ids are dense and
no two writers share one. Readers see whole loads, those that the log held when they
looked. Loads computed from what the table holds (keyed appends) are computed again if
another load has come between.

The folder must be one that all executors and drivers share, on a file system with atomic
renames that refuse to replace (HDFS) or hard links (a local or network disk).
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators.keys import dense_number
from starweave.operators.metrics import write_observed

PLACE = "_sw_place"
ATTEMPT = "_sw_attempt"


@dataclass(frozen=True)
class Commit:
    """One entry of the log. ``first_id``: the id of the load's row at place 0."""

    number: int
    load_id: str
    attempt: str
    rows: int
    first_id: int


class EntryLog:
    """Numbered entries (JSON objects) in the folder ``path``: each is put once, whole, by one writer."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._known: dict[int, dict] = {}

    def java_path(self, name: str):
        """(path, its file system)"""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def entries(self) -> list[dict]:
        """The entries so far, in order; one a load, so their number does not grow with the rows."""
        folder, fs = self.java_path("log")
        if fs.exists(folder):
            for status in fs.listStatus(folder):
                name = status.getPath().getName()
                if name.endswith(".json") and (number := int(name[:-5])) not in self._known:
                    stream = fs.open(status.getPath())
                    try:
                        self._known[number] = json.loads(bytes(stream.readAllBytes()).decode())
                    finally:
                        stream.close()
        return [self._known[n] for n in sorted(self._known)]

    def put(self, number: int, entry: dict) -> bool:
        """Makes the entry, whole or not at all; False if its number is taken."""
        target, fs = self.java_path(f"log/{number:012d}.json")
        draft, _ = self.java_path(f"log/_draft-{os.urandom(8).hex()}")
        out = fs.create(draft, False)
        out.write(json.dumps(entry).encode())
        out.close()
        try:
            if fs.getUri().getScheme() != "file":
                return bool(fs.rename(draft, target))
            os.link(draft.toUri().getPath(), target.toUri().getPath())  # a local rename would replace the entry
        except FileExistsError:
            return False
        except Py4JJavaError:
            if fs.exists(target):
                return False
            raise
        return True


class CommitLog:
    """The table in the folder ``path``: columns ``schema``, numbered in ``order`` within a load as ``id_col`` (if given)."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | str, id_col: str | None = None, order: Sequence[str] = (), first_id: int = 1
    ):
        self.spark, self.path, self.log = spark, path.rstrip("/"), EntryLog(spark, path)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.id_col, self.order, self.start = id_col, list(order), first_id
        if id_col and id_col in self.schema.names:
            raise ValueError(f"{id_col} is given by the log; it is no column of the rows")
        if bool(id_col) != bool(self.order):
            raise ValueError("numbered rows need an order, and only they")

    # ------------------------------------------------------------- the log

    def commits(self) -> list[Commit]:
        """The loads so far, in order."""
        return [Commit(**e) for e in self.log.entries()]

    def find(self, load_id: str) -> Commit | None:
        return next((c for c in self.commits() if c.load_id == load_id), None)

    # ------------------------------------------------------------- writing

    def write_attempt(self, rows: DataFrame) -> tuple[str, int]:
        """Writes rows to a fresh folder: (attempt, number of rows). Nobody reads them before a commit."""
        attempt = f"a{os.urandom(8).hex()}"  # never read as a number
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema.fields])
        if self.id_col:
            rows = dense_number(rows, self.order, PLACE, start=0)
        counted = write_observed(rows, lambda df: df.write.parquet(f"{self.path}/data/{ATTEMPT}={attempt}"), name=f"load-{attempt}")
        return attempt, counted["rows"]

    def commit(self, load_id: str, attempt: str, rows: int, behind: int | None = None) -> Commit | None:
        """The load's entry: this attempt's, or the one of an earlier attempt of the same load.

        ``behind``: the number of entries that the rows were computed from; None is
        returned if there are more by now and the load has to be computed again.
        """
        while True:
            done = self.commits()
            if found := next((c for c in done if c.load_id == load_id), None):
                return found
            if behind is not None and len(done) != behind:
                return None
            first = done[-1].first_id + done[-1].rows if done else self.start
            entry = Commit(len(done), load_id, attempt, rows, first)
            if self.log.put(entry.number, asdict(entry)):
                return entry

    def append(self, load_id: str, rows: DataFrame) -> Commit:
        """Appends the rows once, however often and by however many writers the load is tried."""
        return self.find(load_id) or self.commit(load_id, *self.write_attempt(rows))

    def append_from(self, load_id: str, build: Callable[[DataFrame], DataFrame]) -> Commit:
        """Appends ``build(table)``, for rows that depend on what the table holds; built again if another load comes between."""
        while True:
            done = self.commits()
            if found := next((c for c in done if c.load_id == load_id), None):
                return found
            attempt, n = self.write_attempt(build(self._of(done)))
            if entry := self.commit(load_id, attempt, n, behind=len(done)):
                return entry

    # ------------------------------------------------------------- reading

    def _of(self, commits: Sequence[Commit]) -> DataFrame:
        fields = ([T.StructField(PLACE, T.LongType())] if self.id_col else []) + [T.StructField(ATTEMPT, T.StringType())]
        full = T.StructType([*self.schema.fields, *fields])
        paths = [f"{self.path}/data/{ATTEMPT}={c.attempt}" for c in commits if c.rows]
        if paths:
            rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths)
        else:
            rows = self.spark.createDataFrame([], full)
        if not self.id_col:
            return rows.drop(ATTEMPT)
        firsts = self.spark.createDataFrame([(c.attempt, c.first_id) for c in commits], f"{ATTEMPT} string, _sw_first long")
        joined = rows.join(F.broadcast(firsts), ATTEMPT)  # a row a load
        return joined.select((F.col("_sw_first") + F.col(PLACE)).alias(self.id_col), *self.schema.names)

    def table(self, load_ids: Sequence[str] | None = None) -> DataFrame:
        """The rows of all loads that are committed now (or of those named)."""
        return self._of([c for c in self.commits() if load_ids is None or c.load_id in load_ids])

    def count(self) -> int:
        """Rows of the table, from the log alone."""
        return sum(c.rows for c in self.commits())

    def orphans(self) -> list[str]:
        """Folders of attempts that no entry names: of lost drivers, of losing writers, or of loads at work just now."""
        folder, fs = self.log.java_path("data")
        named = {c.attempt for c in self.commits()}
        found = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(p.toString() for p in found if p.getName().startswith(f"{ATTEMPT}=") and p.getName().split("=", 1)[1] not in named)
