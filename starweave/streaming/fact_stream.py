"""Append FK-resolved fact rows for staging files as they land (D7 + S5 on a stream).

Each micro-batch is resolved against static (already written) dimensions
with the same ``resolve_keys`` as the batch fact, numbered after the rows of
earlier batches, and written to its own ``epoch=<id>`` folder of the sink
with dynamic partition overwrite. A replayed batch (after a failure between
the write and the commit of the stream checkpoint) rewrites the same folder
with the same numbers, so the sink is exactly-once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starweave.operators.keys import dense_number
from starweave.plans.facts import KeyLookup, resolve_keys


def _prior_max(spark: SparkSession, sink_path: str, epoch_id: int) -> int:
    """Largest key of the epochs before, from one row per epoch beside the sink."""
    try:
        tops = spark.read.schema("top long, epoch long").parquet(f"{sink_path}-tops")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # anything else than a sink without batches
            raise
        return 0
    return int(tops.filter(F.col("epoch") < epoch_id).agg(F.max("top")).first()[0] or 0)


def _write_epoch(df: DataFrame, epoch_id: int, path: str) -> None:
    (
        df.withColumn("epoch", F.lit(epoch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("epoch")
        .parquet(path)
    )


def load_fact_batch(
    batch: DataFrame,
    epoch_id: int,
    lookups: Sequence[KeyLookup],
    measures: Sequence[str],
    fact_tk: str,
    sink_path: str,
    row_id: Sequence[str] = (),
) -> None:
    """Resolve, number and write one micro-batch (also usable as a plain batch step)."""
    spark = batch.sparkSession
    resolved = resolve_keys(batch, lookups, [*measures, *row_id])
    order = [lk.tk for lk in lookups] + list(measures)
    start = _prior_max(spark, sink_path, epoch_id) + 1
    numbered = dense_number(resolved, order, fact_tk, start=start, tie=list(row_id))
    rows = Observation()
    _write_epoch(numbered.select(*order, fact_tk).observe(rows, F.count(F.lit(1)).alias("n")), epoch_id, sink_path)
    _write_epoch(spark.range(1).select(F.lit(start - 1 + rows.get["n"]).cast("long").alias("top")), epoch_id, f"{sink_path}-tops")


def start_fact_stream(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType | str,
    lookups: Sequence[KeyLookup],
    measures: Sequence[str],
    fact_tk: str,
    sink_path: str,
    checkpoint_location: str,
    source_format: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    row_id: Sequence[str] = (),
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what has landed, then stops."""
    reader = spark.readStream.schema(schema).format(source_format)
    if source_format == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_path)
    writer = stream.writeStream.foreachBatch(
        lambda df, epoch: load_fact_batch(df, epoch, lookups, measures, fact_tk, sink_path, row_id)
    ).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
