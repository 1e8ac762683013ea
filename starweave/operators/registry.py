"""Surrogate keys that outlive a refresh.

A dimension that is built anew deals its keys anew, and facts loaded before point at
other members. A registry keeps each natural key's surrogate key for good: it is an
append-only table with a commit log, extended only by natural keys that it does not hold,
which take the numbers behind the largest in the order of the new keys. A load that comes
twice, or two writers at once, give no key two numbers and no number two keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starweave.operators.joins import fits_broadcast, lookup_join, null_safe_anti
from starweave.operators.keys import distinct_rows
from starweave.sources.commit_log import Commit, CommitLog
from starweave.sources.files import materialize


class KeyRegistry:
    """The registry in the folder ``path``: columns ``natural_key`` (DDL) to ``tk``; ``first_tk`` leaves 0 to UNKNOWN."""

    def __init__(self, spark: SparkSession, path: str, natural_key: T.StructType | str, tk: str, first_tk: int = 1):
        schema = T.StructType.fromDDL(natural_key) if isinstance(natural_key, str) else natural_key
        self.keys, self.tk = schema.names, tk
        self.log = CommitLog(spark, path, schema, id_col=tk, order=schema.names, first_id=first_tk)

    def table(self) -> DataFrame:
        """(tk, natural key...) of every key that was ever seen."""
        return self.log.table()

    def extend(self, load_id: str, members: DataFrame) -> Commit:
        """Registers the natural keys of ``members`` that are new; keys with a null part have none."""
        members = materialize(distinct_rows(members.dropna(subset=self.keys), self.keys), "registry-members")
        return self.log.append_from(load_id, lambda known: null_safe_anti(members, known, self.keys))

    def keyed(self, members: DataFrame) -> DataFrame:
        """``members`` (registered, one row each) with their surrogate key in front."""
        table = materialize(self.table(), "key-registry")
        pairs: Sequence[tuple[str, str]] = [(k, f"_sw_reg_{k}") for k in self.keys]
        side = table.withColumnsRenamed(dict(pairs))
        joined = lookup_join(members, side, pairs, how="inner", broadcast=fits_broadcast(table))
        return joined.select(self.tk, *members.columns)

