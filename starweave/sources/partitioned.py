"""Facts in date partitions: touched dates are replaced, others are neither read nor written.

A reload of corrected days needs no truncate and no delete: with dynamic partition
overwrite the folders of the dates in the new rows are swapped when the job commits, and
all others stay. A query that filters the date dimension and joins the fact on its partition
column reads the matching folders only: Spark turns the filtered dimension, which it
broadcasts for the join anyway, into a partition filter at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_key(date: Column | str) -> Column:
    """The month of a date as a number (yyyymm); null dates have none."""
    d = F.col(date) if isinstance(date, str) else date
    return (F.year(d) * 100 + F.month(d)).cast("int")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions that ``df`` has rows of (creates the table if need be).

    Rows are dealt by partition with a rebalance: Spark splits a common date over
    several tasks by its size and puts rare dates together, so a date has a few files
    of the advisory size and no task has a whole hot date.
    """
    dealt = df.hint("rebalance", *[F.col(c) for c in partition_by])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_partitioned(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table, with the column types of the rows it was written from."""
    return spark.read.schema(like.schema).parquet(path)


def join_on_partition(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Inner join on the fact's partition column with a filtered dimension, whose rows bound the partitions read.

    ``dim`` is broadcast: it must have at most a row for each partition of the fact (a
    calendar of its months or days), which is a bounded number.
    """
    side = dim.withColumnRenamed(dim_key, "_sw_part") if dim_key else dim.withColumnRenamed(key, "_sw_part")
    return fact.join(F.broadcast(side), F.col(key) == F.col("_sw_part")).drop("_sw_part")
