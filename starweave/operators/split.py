"""Exact, seeded, repeatable sample and its complement.

pandas ``sample(frac, random_state)`` takes exactly round(frac * n) rows.
``df.sample``/``randomSplit`` are only approximate, so rows are ordered by a
60-bit md5 of (seed, row key) and the first k are the sample. Nothing is
sorted globally: the k-th smallest (hash, key) is found with a few narrow
histogram passes over the key column (each pass keeps one bucket of 2^16;
rows are counted while the table is written), and every row is then flagged by comparing
against that threshold tuple - a plain filter, no shuffle of the data being
split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions.hashing import hash60
from starweave.sources.files import materialize, measured

HASH_BITS = 60
LEVEL_BITS = 16
FINAL_ROWS = 200_000


def sample_size(n: int, frac: float) -> int:
    """round(n * frac) with half-to-even, as Python/pandas."""
    return int(round(n * frac))


def _tuple(cols: Sequence[str]) -> Column:
    """(hash, key) as one value: compared part by part, NULL first and equal to NULL."""
    return F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(cols)])


def _literal(hk: DataFrame, cols: Sequence[str], values: Sequence) -> Column:
    types = {f.name: f.dataType for f in hk.schema.fields}
    return F.struct(*[F.lit(v).cast(types[c]).alias(f"p{i}") for i, (c, v) in enumerate(zip(cols, values))])


def _histogram(hk: DataFrame, cond: Column, shift: int) -> list[tuple[int, int]]:
    """(bucket, rows) of ``_sw_h >> shift`` among rows matching ``cond``.

    At most 2^LEVEL_BITS rows: a bounded aggregate, collected to the driver.
    """
    rows = (
        hk.filter(cond)
        .groupBy(F.shiftright("_sw_h", shift).alias("_b"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .collect()
    )
    return sorted((r["_b"], r["_n"]) for r in rows)


def _locate(hist: list[tuple[int, int]], k: int) -> tuple[int, int, int]:
    """Bucket holding the k-th row, its size, and k within it."""
    before = 0
    for bucket, n in hist:
        if before + n >= k:
            return bucket, n, k - before
        before += n
    raise ValueError("k exceeds the histogram total")


def kth_smallest(hk: DataFrame, k: int, key: Sequence[str], n: int | None = None) -> tuple:
    """The k-th smallest (_sw_h, *key) tuple of ``hk`` (1-based), by refinement."""
    cond = F.lit(True)
    shift = HASH_BITS
    remaining = hk.count() if n is None else n
    while remaining > FINAL_ROWS and shift > 0:
        shift = max(shift - LEVEL_BITS, 0)
        bucket, remaining, k = _locate(_histogram(hk, cond, shift), k)
        cond = cond & (F.shiftright("_sw_h", shift) == F.lit(bucket))
    if remaining > FINAL_ROWS:
        raise ValueError(f"{remaining} rows share one hash: the key does not identify rows")
    ordered = hk.filter(cond).orderBy("_sw_h", *key).offset(k - 1).limit(1).first()
    return tuple(ordered[c] for c in ["_sw_h", *key])


def split_flag(df: DataFrame, key: Sequence[str], frac: float, seed, out: str = "is_test") -> DataFrame:
    """Flag exactly round(frac * n) rows (smallest seeded hash) as the sample.

    NULL is a key value like any other. Raises if the key does not identify
    the rows at the threshold, since no exact split of equal keys is repeatable.
    """
    cols = ["_sw_h", *key]
    hashed = df.withColumn("_sw_h", hash60(seed, *key))
    # the passes read a narrow written table (hash + key), not the source plan
    hk = materialize(hashed.select(*cols), "split-keys")
    n = measured(hk)[0]
    k = sample_size(n, frac)
    if k <= 0:
        flag = F.lit(False)
    elif k >= n:
        flag = F.lit(True)
    else:
        threshold = kth_smallest(hk, k, key, n)
        below = _tuple(cols) <= _literal(hk, cols, threshold)
        taken = hk.filter(below).count()
        if taken != k:
            raise ValueError(f"{taken} rows reach the threshold instead of {k}: the key {list(key)} is not unique")
        flag = below
    return hashed.withColumn(out, flag).drop("_sw_h")


def exact_split(df: DataFrame, key: Sequence[str], frac: float, seed) -> tuple[DataFrame, DataFrame]:
    """(rest, sample): disjoint and exhaustive (R2)."""
    flagged = split_flag(df, key, frac, seed, "_sw_test")
    rest = flagged.filter(~F.col("_sw_test")).drop("_sw_test")
    sample = flagged.filter(F.col("_sw_test")).drop("_sw_test")
    return rest, sample
