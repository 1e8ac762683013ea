"""Column cleaning, recoding and derived measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions.dates import elapsed_days
from starweave.functions.hashing import hash_mod
from starweave.operators.joins import lookup_join


def drop_columns(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop named columns (P1). ``strict`` raises on a missing column like pandas."""
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Project named columns in the given order."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (P5)."""
    return df.withColumnsRenamed(dict(mapping))


def try_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; values that do not parse become NULL (F5-F7, ANSI-safe, G7)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def cast_bool_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Programmatic projection with boolean casts."""
    return try_cast_columns(df, {c: "boolean" for c in cols})


def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``cols``.

    Written as ``isNotNull`` filters (not ``dropna``) so they reach the scan;
    float keys also drop NaN, as pandas does.
    """
    types = dict(df.dtypes)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
        if types.get(c) in ("float", "double"):
            cond = cond & ~F.isnan(F.col(c))  # pandas' dropna also drops NaN
    return df.filter(cond)


def fill_unknown(df: DataFrame, cols: Sequence[str] | None = None, value: str = "unknown") -> DataFrame:
    """Fill every NULL with a text constant, any column type.

    ``na.fill`` touches string columns only, so target columns become text first.
    """
    targets = cols if cols is not None else df.columns
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in targets})


def recode(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Small code -> label recode; unmatched values and NULL pass through."""
    if not mapping:
        return df
    expr: Column | None = None
    for code, label in mapping.items():
        cond = F.col(col) == F.lit(code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(col, expr.otherwise(F.col(col)))


def unique_lookup(lookup: DataFrame, code: str, label: str, seq: str) -> DataFrame:
    """One label per code: the entry with the highest sequence wins.

    A hash aggregate with map-side partial ``max_by``, so repeated codes are
    reduced before the shuffle.
    """
    return lookup.groupBy(code).agg(F.max_by(F.col(label), F.col(seq)).alias(label))


def recode_lookup(
    df: DataFrame,
    col: str,
    lookup: DataFrame,
    code: str = "code",
    label: str = "label",
    seq: str = "seq",
    out: str | None = None,
) -> DataFrame:
    """Large-table recode; unmatched codes pass through.

    The lookup is made unique by code first, so the left join cannot add rows;
    it is broadcast when its estimated size allows, else shuffle-joined.
    """
    uniq = unique_lookup(lookup, code, label, seq).select(
        F.col(code).alias("_sw_code"), F.col(label).alias("_sw_label")
    )
    joined = lookup_join(df, uniq, [(F.col(col).cast("string"), "_sw_code")])
    target = out or col
    return joined.withColumn(target, F.coalesce(F.col("_sw_label"), F.col(col).cast("string"))).drop(
        "_sw_code", "_sw_label"
    )


def synthetic_int(df: DataFrame, out: str, lo: int, hi: int, seed, key: Sequence[str]) -> DataFrame:
    """Uniform integer in [lo, hi) from (seed, row key): repeatable random measure."""
    return df.withColumn(out, (F.lit(lo) + hash_mod(seed, out, hi - lo, *key)).cast("int"))


def derive_duration(
    df: DataFrame, begin: str, end: str, out: str, seed, key: Sequence[str]
) -> DataFrame:
    """Duration in hours from whole elapsed days.

    0 elapsed days -> a repeatable pseudo-random 1..24 hours; else days * 24.
    A NULL condition falls to the ``otherwise`` branch, as ``np.where`` does.
    """
    days = elapsed_days(begin, end)
    imputed = F.lit(1) + hash_mod(seed, out, 24, *key)
    return df.withColumn(out, F.when(days == 0, imputed).otherwise(days * 24).cast("int"))


def duration_fallback(df: DataFrame, begin: str, end: str, dur: str) -> DataFrame:
    """Keep a given duration, else calendar days * 24."""
    return df.withColumn(
        dur, F.coalesce(F.col(dur).cast("int"), (F.datediff(F.col(end), F.col(begin)) * 24).cast("int"))
    )
