"""Lookups that pick the version of a dimension member valid at a row's time (E1, E5 into D7).

A type-2 dimension has several rows for one natural key; a join on the key alone would
multiply the fact. ``as_of_lookup`` finds for each row the latest version that began at or
before the row's time, and takes it if it had not ended by then. A row stays one row
whatever the dimension holds, overlapping versions included.

There is no range join. A dimension measured to fit a broadcast is grouped to one row a
key with its versions in an array, which the joined row searches. Otherwise versions and
rows are put together, sorted by key and time, and the last version seen is carried to the
rows behind it: one shuffle of the fact, and no row meets a version but the one carried. A
hot key's rows are cut into slices of time; a version goes to the slice it begins in and to
those behind it (hot keys and slices are bounded numbers). Rows of one instant that is more
common than a slice are dealt over the slices that share the instant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators.joins import HOT_KEY_SALTS, HOT_SAMPLE_FRACTION, NULL_KEY_SALTS, _as_col, fits_broadcast, hot_keys, key_json

Pairs = Sequence[tuple[Column | str, Column | str]]


def as_of_lookup(
    fact: DataFrame,
    versions: DataFrame,
    on: Pairs,
    at: Column | str,
    tk: str,
    out: str | None = None,
    unknown_tk: int | None = 0,
    date_from: str = "date_from",
    date_to: str = "date_to",
    broadcast: bool | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``fact`` with the ``tk`` of the version valid ``at`` the row's time, as column ``out`` (default: ``tk``).

    ``on``: pairs of a fact expression and a dimension expression. A version is valid from
    ``date_from`` (null: always was) up to, but not at, ``date_to`` (null: still is). Of
    versions that began together the one with the largest ``tk`` counts. Rows with a null
    key or time, before the first version, or in a gap between two get ``unknown_tk``.
    ``broadcast`` says that the dimension was measured and fits (default: ask it); ``hot``
    are the slices of hot keys (``hot_slices``), found in a sample if not given.
    """
    out = out or tk
    kind = versions.schema[date_from].dataType
    keys = [f"_sw_k{i}" for i in range(len(on))]
    known = versions.select(
        *[_as_col(d).alias(k) for k, (_, d) in zip(keys, on)],
        F.col(date_from).alias("_sw_from"), F.col(tk).cast("bigint").alias("_sw_tk"), F.col(date_to).cast(kind).alias("_sw_to"),
    ).dropna(subset=keys)
    rows = fact.select("*", *[_as_col(f).alias(k) for k, (f, _) in zip(keys, on)], _as_col(at).cast(kind).alias("_sw_at"))
    if fits_broadcast(versions) if broadcast is None else broadcast:
        found = _searched(rows, known, keys)
    else:
        found = _carried(rows, known, keys, hot_slices(rows, keys, "_sw_at") if hot is None else hot)
    valid = F.col("_sw_v._sw_to").isNull() | (F.col("_sw_at") < F.col("_sw_v._sw_to"))
    tk_at = F.coalesce(F.when(valid, F.col("_sw_v._sw_tk")), F.lit(unknown_tk).cast("bigint"))
    return found.withColumn("_sw_found", tk_at).select(*[F.col(f"`{c}`") for c in fact.columns], F.col("_sw_found").alias(out))


def _searched(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``_sw_v``, the latest version begun, from a broadcast array of each key's versions."""
    grouped = known.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_sw_from", "_sw_tk", "_sw_to"))).alias("_sw_all"))
    grouped = grouped.withColumnsRenamed({k: f"{k}d" for k in keys})
    joined = rows.join(F.broadcast(grouped), [F.col(k) == F.col(f"{k}d") for k in keys], "left")
    begun = F.filter("_sw_all", lambda v: v["_sw_from"].isNull() | (v["_sw_from"] <= F.col("_sw_at")))
    return joined.withColumn("_sw_v", F.when(F.col("_sw_at").isNotNull(), F.try_element_at(begun, F.lit(-1))))


def _carried(rows: DataFrame, known: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """``rows`` with ``_sw_v``, the latest version begun, carried along each key's rows in order of time."""
    carried = [*keys, "_sw_slice", "_sw_time", "_sw_tie", "_sw_v", "_sw_row"]
    place = F.xxhash64(F.monotonically_increasing_id())
    no_key = F.col("_sw_at").isNull()
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    low, high = _slice("_sw_at")
    among = F.lit(-1) - F.pmod(place, F.lit(NULL_KEY_SALTS))  # no version ever comes there
    r = rows.withColumn("_sw_row", F.struct(*[F.col(f"`{c}`") for c in rows.columns])).withColumn("_sw_json", key_json(keys))
    r = r.join(F.broadcast(hot), "_sw_json", "left").withColumn(
        "_sw_slice", F.when(no_key, among).when(F.col("_sw_cuts").isNull(), F.lit(0)).otherwise(low + F.pmod(place, high - low + 1)).cast("bigint"))
    v = known.withColumn("_sw_json", key_json(keys)).join(F.broadcast(hot), "_sw_json", "left")
    first = _slice("_sw_from")[0].cast("bigint")
    slices = F.when(F.col("_sw_cuts").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(first, F.size("_sw_cuts").cast("bigint")))
    v = v.withColumn("_sw_slice", F.explode(slices)).withColumn("_sw_v", F.struct("_sw_tk", "_sw_to"))
    r = r.select(*carried[:-4], F.col("_sw_at").alias("_sw_time"), F.lit(None).cast("bigint").alias("_sw_tie"), F.lit(None).cast(v.schema["_sw_v"].dataType).alias("_sw_v"), "_sw_row")
    v = v.select(*carried[:-4], F.col("_sw_from").alias("_sw_time"), F.col("_sw_tk").alias("_sw_tie"), "_sw_v", F.lit(None).cast(r.schema["_sw_row"].dataType).alias("_sw_row"))
    # versions of an instant stand before its rows, the one with the largest key last
    order = Window.partitionBy(*keys, "_sw_slice").orderBy(F.col("_sw_time").asc_nulls_first(), F.col("_sw_tie").asc_nulls_last())
    seen = F.last("_sw_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = v.unionByName(r).withColumn("_sw_v", seen).where("_sw_row is not null")
    return both.select("_sw_row.*", "_sw_v")


def _slice(time: str) -> tuple[Column, Column]:
    """First and last slice that the instant may lie in: as many cuts lie before it, or at it as well."""
    t = F.col(time)
    return F.size(F.filter("_sw_cuts", lambda c: c < t)), F.size(F.filter("_sw_cuts", lambda c: c <= t))


def hot_slices(rows: DataFrame, keys: Sequence[str], at: str, slices: int = HOT_KEY_SALTS, fraction: float = HOT_SAMPLE_FRACTION) -> DataFrame:
    """(_sw_json, _sw_cuts): for each hot key of a sample of ``rows``, the times that cut its rows into even slices.

    At most a hundred keys (``joins.hot_keys``) and ``slices - 1`` cuts each; collected once, so
    that rows and versions are cut alike. A key missed here changes the work of a task, not the result.
    """
    spark = rows.sparkSession
    schema = T.StructType([T.StructField("_sw_json", T.StringType()), T.StructField("_sw_cuts", T.ArrayType(rows.schema[at].dataType))])
    found = hot_keys(rows.where(F.col(at).isNotNull()), {"key": list(keys)}, fraction=fraction)["key"]
    if not found:
        return spark.createDataFrame([], schema)
    sample = rows.where(F.col(at).isNotNull()).sample(fraction=min(1.0, 4 * fraction), seed=23)
    mine = sample.select(key_json(keys).alias("_sw_json"), F.col(at)).where(F.col("_sw_json").isin(found))
    share = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    cuts = mine.groupBy("_sw_json").agg(F.percentile_approx(at, share).alias("_sw_cuts"))
    return spark.createDataFrame([tuple(r) for r in cuts.collect()], schema)
