"""CSV / Parquet readers and writers."""

from __future__ import annotations

import os
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    infer: bool = False,
) -> DataFrame:
    """CSV scan. An explicit schema keeps codes such as ``01001`` as text (S1);
    ``infer=True`` reproduces header+inferSchema (S2, an extra pass over the file)."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """CSV sink with a header row, written in parallel by the executors."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan (column pruning and filters reach the reader; splits are a session setting)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


# What was measured while an intermediate was written, by the DataFrame read back.
_MEASURED: WeakKeyDictionary[DataFrame, tuple[int, int]] = WeakKeyDictionary()


def _row_bytes(df: DataFrame):
    """Decoded size of a row: 8 bytes a column, and the text or binary itself."""
    size = F.lit(8 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0))
    return size


def measured(df: DataFrame) -> tuple[int, int] | None:
    """(rows, decoded bytes) counted while ``df`` was written; None for any other DataFrame."""
    return _MEASURED.get(df)


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage (an executor lost later re-reads files instead of
    recomputing joins) and lets a following range partitioning sample a written
    table instead of re-running the whole upstream plan. Rows and decoded bytes
    are counted while writing; see ``measured``. ``codec`` (default: the session's) is for
    large tables that are no side of a join: Spark takes the size of a side from its files.
    """
    from starweave.session import shared_path

    spark = df.sparkSession
    path = shared_path(spark, name)
    obs = Observation(f"{name}-{os.urandom(4).hex()}")
    tagged = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes"))
    tagged.write.mode("overwrite").parquet(path, compression=codec)
    back = spark.read.schema(df.schema).parquet(path)
    _MEASURED[back] = (int(obs.get.get("rows") or 0), int(obs.get.get("bytes") or 0))  # run check (A4)
    return back


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
