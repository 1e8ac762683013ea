"""Deduplication, dense surrogate keys, SCD columns, UNKNOWN member.

``dense_number`` is the scalable form of ``row_number() over (order by ...)``:
the reference's global window sends every row to one task. Here rows are
range-partitioned on the full ordering, sorted and numbered inside each
partition, and written once with their partition and place. The sizes of the
partitions are then read from those same files, so the running totals that
shift the places cannot disagree with the rows, whatever the plan does.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOW_BITS = (1 << 33) - 1
FINE_RANGES = 4096
RANGE_BYTES = 1 << 30


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_bytes(text: str) -> int:
    """'67108864b', '64m', '1g' -> bytes (Spark size-string convention)."""
    t = str(text).strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if t and t[-1] in units:
        return int(float(t[:-1]) * units[t[-1]])
    return int(t)


def range_partitions(spark, size: int) -> int:
    """Ranges for ``size`` measured bytes.

    Each is about one advisory partition, up to ``FINE_RANGES`` of them; beyond that their
    number stays until each holds ``RANGE_BYTES`` (sorting one spills), since every task of the
    shuffle writes an index entry for every range.
    """
    advisory = parse_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
    fine = -(-size // max(advisory, 1))
    return max(1, min(fine, max(FINE_RANGES, -(-size // RANGE_BYTES))))


def fixed_bytes(df: DataFrame, rows: int | None) -> int | None:
    """Decoded bytes of ``rows`` rows if all columns have a fixed width, else None."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if rows is None or not all(isinstance(f.dataType, fixed) for f in df.schema.fields):
        return None
    return 8 * len(df.columns) * rows


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """DISTINCT over the selected columns (A1); partial + final hash aggregate."""
    return (df.select(*cols) if cols else df).distinct()


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep one row per key: the first by ``order`` (A2, A3, G1).

    Deterministic replacement for ``dropDuplicates``. A rank-1 filter over a
    key-partitioned window plans a partial ``WindowGroupLimit`` before the
    shuffle, so each map task ships at most one row per key: a hot key costs
    no more than a cold one.
    """
    w = Window.partitionBy(*keys).orderBy(*[_col(o) for o in order])
    return df.withColumn("_sw_rn", F.row_number().over(w)).filter(F.col("_sw_rn") == 1).drop("_sw_rn")


def first_by_attributes(df: DataFrame, keys: Sequence[str], rank_col: str | None = None) -> DataFrame:
    """``dedup`` ordered by (source rank, every other column ascending, NULLs last)."""
    attrs = [c for c in df.columns if c not in keys and c != rank_col]
    order: list[Column] = [F.col(rank_col).asc()] if rank_col else []
    order += [F.col(a).asc_nulls_last() for a in attrs]
    return dedup(df, keys, order)


def dense_number(
    df: DataFrame,
    order: Sequence[str],
    out: str,
    start: int = 1,
    tie: Sequence[str] = (),
    partitions: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """``row_number() over (order by order..., tie...)`` (ascending, NULLs first), as bigint.

    The input is written first unless it is a written intermediate already: the
    range exchange samples it in a separate pass, and its measured bytes give
    the number of ranges (``partitions`` overrides it). An input of at most one
    advisory partition is one range and needs no offsets; if the caller knows from
    measured tables that the input has ``at_most`` so many rows of fixed width, and
    they fit one range, it isn't written either.

    Identical rows get consecutive numbers (which one gets which cannot be
    told apart). A row id as ``tie`` lets a mass of identical rows spread over
    several range partitions instead of one. The remaining columns are added
    as trailing sort keys, so equal inputs are numbered alike.
    """
    from starweave.sources.files import materialize, measured

    spark = df.sparkSession
    lead = list(order) + [t for t in tie if t not in order]
    rest = [c for c in df.columns if c not in lead]
    sort_cols = [F.col(c).asc_nulls_first() for c in lead + rest]
    bound = fixed_bytes(df, at_most)
    if partitions is None and bound is not None and range_partitions(spark, bound) == 1:
        n_parts = 1
    else:
        if measured(df) is None:
            df = materialize(df, "numbering-input", codec="zstd")
        n_parts = partitions or range_partitions(spark, measured(df)[1])
    if n_parts == 1:
        w = Window.orderBy(*sort_cols)
        return df.withColumn(out, (F.row_number().over(w) + F.lit(start - 1)).cast("bigint"))

    # monotonically_increasing_id: partition in the high bits, place in the low 33
    ranged = (
        df.repartitionByRange(n_parts, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_sw_id", F.monotonically_increasing_id())
        .withColumns({"_sw_part": F.shiftright("_sw_id", 33), "_sw_place": F.col("_sw_id").bitwiseAND(F.lit(_LOW_BITS))})
    )
    placed = materialize(ranged.drop("_sw_id"), "numbered", codec="zstd")
    # one row per range: broadcasting and ordering them is bounded by their number
    sizes = placed.groupBy("_sw_part").agg((F.max("_sw_place") + 1).alias("_sw_n"))
    before = Window.orderBy("_sw_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_sw_part", F.coalesce(F.sum("_sw_n").over(before), F.lit(0)).alias("_sw_off"))
    numbered = placed.join(F.broadcast(offsets), "_sw_part")
    numbered = numbered.withColumn(out, (F.col("_sw_off") + F.col("_sw_place") + F.lit(start)).cast("bigint"))
    return numbered.drop("_sw_part", "_sw_place", "_sw_off")


def global_number(df: DataFrame, order: Sequence[str], out: str, start: int = 1) -> DataFrame:
    """Reference form (single-partition window); kept for small inputs and plan comparison."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(out, (F.row_number().over(w) + F.lit(start - 1)).cast("bigint"))


def surrogate_key(df: DataFrame, natural_key: Sequence[str], out: str, start: int = 1, at_most: int | None = None) -> DataFrame:
    """Deterministic 1..n in natural-key order; 0 stays reserved for UNKNOWN (K1)."""
    return dense_number(df, natural_key, out, start=start, at_most=at_most)


def ntz_literal(ts: datetime | str) -> Column:
    text = ts.isoformat(sep=" ") if isinstance(ts, datetime) else str(ts)
    return F.to_timestamp_ntz(F.lit(text))


def scd1_columns(df: DataFrame, load_ts: datetime | str, version: int = 1) -> DataFrame:
    """version=1, date_from=load time, date_to=NULL (K3; one literal per run, G6)."""
    return df.withColumns(
        {
            "version": F.lit(version).cast("int"),
            "date_from": ntz_literal(load_ts),
            "date_to": F.lit(None).cast(T.TimestampNTZType()),
        }
    )


def _typed_literal(value, dtype: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, (datetime, str)):
        return ntz_literal(value)
    if isinstance(dtype, T.DateType) and isinstance(value, (date, str)):
        return F.to_date(F.lit(str(value)))
    return F.lit(value).cast(dtype)


def literal_row(df_like: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """One row with ``df_like``'s schema; missing columns are NULL."""
    spark = df_like.sparkSession
    cols = [_typed_literal(values.get(f.name), f.dataType).alias(f.name) for f in df_like.schema.fields]
    return spark.range(1).select(*cols)


def with_unknown_member(dim: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Prepend the UNKNOWN member (tk 0, per-dimension defaults)."""
    return literal_row(dim, values).unionByName(dim)


def without_reserved(df: DataFrame, key: Iterable[str], reserved: Mapping[str, object]) -> DataFrame:
    """Remove natural members equal to the reserved UNKNOWN label."""
    cond = F.lit(True)
    for k in key:
        if k in reserved:
            cond = cond & F.col(k).eqNullSafe(F.lit(reserved[k]))
    return df.filter(~cond)
