"""Tables bucketed by a key, for joins that come again and again.

A fact that is joined to the same large dimension by every load and report pays a shuffle
of the fact each time. Written in buckets of the key, as many as the dimension's, both
sides lie where the join wants them: bucket meets bucket, nothing is exchanged. Rows
whose key is null can match nothing and would all share one bucket; they are kept beside
the table, dealt evenly, and come back with the unknown member.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.session import shared_path

BUCKETS = 64


class Colocated:
    """A table written in buckets of ``keys``; ``rest``: the rows with a null key part."""

    def __init__(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int = BUCKETS):
        spark = df.sparkSession
        self.keys, self.buckets, self.columns = list(keys), buckets, df.columns
        path = shared_path(spark, name)
        self.name = f"sw_{path.rsplit('-', 1)[1]}_{name.lower().replace('-', '_')}"
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        # dealt by the keys first, so that a bucket is one file and is read in its order
        dealt = df.filter(known).repartition(buckets, *self.keys)
        dealt.write.bucketBy(buckets, *self.keys).sortBy(*self.keys).option("path", f"{path}/buckets").saveAsTable(self.name)
        df.filter(~known).write.parquet(f"{path}/rest")
        self.table = spark.table(self.name)
        self.rest = spark.read.schema(df.schema).parquet(f"{path}/rest")


def colocated_lookup(fact: Colocated, dim: Colocated, tk: str, unknown_tk: int = 0) -> DataFrame:
    """Every fact row with the ``tk`` of its dimension row, whose keys are unique (else ``unknown_tk``); no exchange.

    The key columns pair up in order and must have equal types and bucket numbers.
    """
    pairs = list(zip(fact.keys, dim.keys, strict=True))
    types = [(fact.table.schema[f].dataType, dim.table.schema[d].dataType) for f, d in pairs]
    if fact.buckets != dim.buckets or any(a != b for a, b in types):
        raise ValueError("the tables are not bucketed alike")
    side = dim.table.select(F.col(tk).cast("bigint").alias("_sw_tk"), *[F.col(d).alias(f"_sw_d{i}") for i, (_, d) in enumerate(pairs)]).hint("merge")
    joined = fact.table.join(side, [F.col(f) == F.col(f"_sw_d{i}") for i, (f, _) in enumerate(pairs)], "left")
    found = joined.select(*fact.columns, F.coalesce("_sw_tk", F.lit(unknown_tk).cast("bigint")).alias(tk))
    return found.unionByName(fact.rest.withColumn(tk, F.lit(unknown_tk).cast("bigint")))
