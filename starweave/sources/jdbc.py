"""JDBC tables.

Reads are split into ranges of a numeric column so executors read in
parallel; bounds come from one ``min/max`` query. Writes are set-based from
the executors: full refresh keeps the table definition (``truncate``), loads
append. Any JDBC database works; tests use embedded in-memory Derby (no
server, no port).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    num_partitions: int = 1,
    bounds: tuple[int, int] | None = None,
    quote: bool = True,
) -> DataFrame:
    """Table scan; with ``partition_column`` it is read as ``num_partitions`` ranges.

    ``quote`` quotes the column in the bounds query (Spark creates tables with
    quoted, case-sensitive column names).
    """
    props = dict(properties)
    if not partition_column or num_partitions <= 1:
        return spark.read.jdbc(url, table, properties=props)
    if bounds is None:
        col = f'"{partition_column}"' if quote else partition_column
        q = f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table}) b"
        row = spark.read.jdbc(url, q, properties=props).first()
        lo, hi = row[0], row[1]
        if lo is None:
            return spark.read.jdbc(url, table, properties=props)
        bounds = (int(lo), int(hi) + 1)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=num_partitions,
        properties=props,
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "overwrite",
    truncate: bool = True,
    column_types: str | None = None,
) -> None:
    """Full refresh (``overwrite`` + ``truncate`` keeps DDL/constraints) or ``append``."""
    writer = df.write.mode(mode)
    if mode == "overwrite" and truncate:
        writer = writer.option("truncate", "true")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, table, properties=dict(properties))


def derby_memory(spark: SparkSession, db: str, log_path: str | None = None) -> tuple[str, dict]:
    """URL + properties of an embedded in-memory Derby database (tests, examples)."""
    jvm = spark.sparkContext._jvm
    if log_path:
        jvm.java.lang.System.setProperty("derby.stream.error.file", log_path)
    return f"jdbc:derby:memory:{db};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
