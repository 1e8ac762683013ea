"""Bloom filters built by aggregation and shipped as a one-row table.

A keyed append compares a small batch with all that a table holds, and an equi-join would
shuffle the whole table to find out that most of it has nothing to do with the batch. A
filter of the batch's keys drops those rows inside the scan's tasks; an exact join behind
it settles what is left, so a false positive costs a shuffled row and nothing else.

The bits are made by Spark: every key sets ``HASHES`` bits, words of 64 bits are or-ed
with partial aggregation, and the words become one array. Filters of one size merge by
or-ing. The size follows the counted keys; beyond ``MAX_BITS`` there is no filter and the
exact join does all the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS_PER_KEY = 16
HASHES = 4
MAX_BITS = 1 << 28  # 32 MiB on every executor
MIN_BITS = 1 << 12


def size_for(keys: int) -> int | None:
    """Bits (a power of two) for so many keys; None if there are too many."""
    bits = MIN_BITS
    while bits < keys * BITS_PER_KEY:
        bits *= 2
    return bits if bits <= MAX_BITS else None


def _positions(cols: Sequence[Column], bits: int) -> list[Column]:
    """The bits that a key sets: one hash, and steps of another. Nulls are values like any other."""
    nulls = [c.isNull() for c in cols]
    start = F.xxhash64(*cols, *nulls).bitwiseAND(F.lit(bits - 1))
    step = F.xxhash64(F.lit(7919), *cols, *nulls).bitwiseAND(F.lit(bits - 1))
    return [(start + i * (2 * F.floor(step / 2) + 1)).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def bit_words(places: DataFrame, bits: int) -> DataFrame:
    """One row (_sw_bits array<bigint>): ``bits`` bits, in words of 64, of which those numbered in the column ``at`` are set."""
    set_bits = places.select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("mask"))
    empty = places.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    each = set_bits.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    return each.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda x: x["mask"]).alias("_sw_bits"))


def bloom_filter(df: DataFrame, cols: Sequence[str], bits: int) -> DataFrame:
    """One row (_sw_bits array<bigint>): the filter of the keys ``cols`` of all rows of ``df``."""
    return bit_words(df.select(F.explode(F.array(*_positions([F.col(c) for c in cols], bits))).alias("at")), bits)


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """The filter of both sides' keys; the filters must be of one size."""
    both = one.unionByName(other).agg(F.collect_list("_sw_bits").alias("all"))
    same = F.size(F.get("all", F.lit(0))) == F.size(F.get("all", F.lit(1)))
    ored = F.zip_with(F.get("all", F.lit(0)), F.get("all", F.lit(1)), lambda a, b: a.bitwiseOR(b))
    return both.select(F.when(same, ored).otherwise(F.raise_error(F.lit("filters of different sizes"))).alias("_sw_bits"))


def may_hold(bits: Column, cols: Sequence[Column], size: int) -> Column:
    """Whether a filter of ``size`` bits may hold the key: False is certain."""
    hit = F.lit(True)
    for at in _positions(cols, size):
        word = F.get(bits, F.shiftright(at, 6).cast("int"))
        hit = hit & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return hit


def comparable(one: DataFrame, cols: Sequence[str], other: DataFrame, other_cols: Sequence[str]) -> bool:
    """Whether equal keys have equal hashes: same types, and no floating point (its zeros and NaNs are equal in joins)."""
    exact = (T.IntegralType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
    pairs = [(one.schema[a].dataType, other.schema[b].dataType) for a, b in zip(cols, other_cols)]
    return all(x == y and isinstance(x, exact) for x, y in pairs)


def pruned(df: DataFrame, cols: Sequence[str], of: DataFrame, of_cols: Sequence[str], keys: int | None) -> DataFrame:
    """``df`` without the rows whose key ``of`` certainly does not hold; ``keys``: the rows of ``of``, if counted.

    Unchanged if the keys were not counted, are too many, or are of types whose hashes
    do not follow equality. Null keys are kept if ``of`` has null keys.
    """
    bits = size_for(keys) if keys is not None and comparable(df, cols, of, of_cols) else None
    if bits is None:
        return df
    filt = F.broadcast(bloom_filter(of, of_cols, bits))  # one row of at most MAX_BITS
    return df.crossJoin(filt).where(may_hold(F.col("_sw_bits"), [F.col(c) for c in cols], bits)).drop("_sw_bits")
