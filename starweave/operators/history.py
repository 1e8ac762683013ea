"""Slowly-changing history and fact roll-ups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.operators.joins import fits_broadcast, hot_keys, lookup_join
from starweave.operators.keys import dense_number, ntz_literal
from starweave.sources.files import materialize


def scd2_merge(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    attrs: Sequence[str],
    tk: str,
    load_ts: datetime | str,
    unknown_tk: int = 0,
    top: int | None = None,
) -> DataFrame:
    """Type-2 merge of ``incoming`` (one row per natural key) into a dimension.

    Raises if a key comes in twice, since its successor would be ambiguous.

    Open rows whose attributes changed (NULL-safe compare) are closed at
    ``load_ts`` and get a successor with version + 1; new keys enter with
    version 1; new rows take keys after the current maximum, in natural-key
    order. Closed history and the UNKNOWN member pass through unchanged. If ``current``
    is a part of the dimension, ``top`` is the largest key of the whole.
    """
    ts = ntz_literal(load_ts)
    is_open = F.col("date_to").isNull() & (F.col(tk) != F.lit(unknown_tk))
    fixed = current.filter(~is_open)
    open_rows = current.filter(is_open)
    inc = incoming.select(*[F.col(c).alias(f"_in_{c}") for c in [*keys, *attrs]]).withColumn("_in", F.lit(True))

    cond = [open_rows[k].eqNullSafe(inc[f"_in_{k}"]) for k in keys]
    # written once: closed rows and successors read the same join result
    j = materialize(open_rows.join(inc, cond, "full_outer"), "scd2-join")
    twice = j.filter(F.col("_in")).groupBy(*[f"_in_{k}" for k in keys]).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"incoming rows repeat a natural key: {tuple(twice)[:-1]}")
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"_in_{a}"))
    has_cur = F.col(tk).isNotNull()
    has_new = F.col("_in").isNotNull()
    changed = has_cur & has_new & ~same

    kept = j.filter(has_cur).select(
        F.col(tk),
        F.col("version"),
        F.col("date_from"),
        F.when(changed, ts).otherwise(F.col("date_to")).alias("date_to"),
        *[F.col(c) for c in [*keys, *attrs]],
    )
    successors = j.filter(has_new & (changed | ~has_cur)).select(
        F.coalesce(F.col("version") + 1, F.lit(1)).cast("int").alias("version"),
        ts.alias("date_from"),
        F.lit(None).cast("timestamp_ntz").alias("date_to"),
        *[F.col(f"_in_{c}").alias(c) for c in [*keys, *attrs]],
    )
    if top is None:
        top = current.agg(F.max(tk)).first()[0] or 0
    numbered = dense_number(successors, list(keys), tk, start=int(top) + 1)
    cols = current.columns
    return fixed.select(*cols).unionByName(kept.select(*cols)).unionByName(numbered.select(*cols))


def scd2_history(dim: DataFrame, keys: Sequence[str], attr: str, version: str = "version") -> DataFrame:
    """Changes of ``attr`` per natural key, version by version (E5).

    The previous version is found with an equi-join on (key, version) =
    (key, version + 1) instead of ``lag`` over a key-partitioned window: the
    join keys are unique, so a key with very many versions is not one task.
    """
    cur = dim.filter(F.col(version) > 1).select(*keys, version, F.col(attr).alias("new_value"))
    prev = dim.select(
        *[F.col(k).alias(f"_sw_p_{k}") for k in keys],
        (F.col(version) + 1).alias("_sw_p_next"),
        F.col(attr).alias("previous_value"),
    )
    cond = [cur[k].eqNullSafe(prev[f"_sw_p_{k}"]) for k in keys] + [cur[version] == prev["_sw_p_next"]]
    joined = cur.join(prev, cond, "left")
    return joined.filter(~F.col("previous_value").eqNullSafe(F.col("new_value"))).select(
        *keys, version, "previous_value", "new_value"
    )


def level_rows(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, Sequence[tuple[str, Column]]]], sampled: DataFrame | None = None
) -> DataFrame:
    """``fact`` with the dimension attributes that it is rolled up by (E2); ``dims`` = [(dim, tk, [(name, expr over dim)])].

    Hot keys are looked for in a sample of ``fact``. A sample of the end of a plan runs all of
    it: where joins stand before, ``sampled`` holds the tks of a sample drawn ahead of them.
    """
    shuffled = {tk: [F.col(tk)] for dim, tk, _ in dims if not fits_broadcast(dim)}
    hot = hot_keys(fact, shuffled) if sampled is None else hot_keys(sampled, shuffled, fraction=1.0)
    out = fact
    for dim, tk, attrs in dims:
        side = dim.select(F.col(tk).alias("_sw_tk"), *[expr.alias(name) for name, expr in attrs])
        out = lookup_join(out, side, [(F.col(tk), "_sw_tk")], broadcast=tk not in shuffled, hot=hot.get(tk))
    return out


def rollup_levels(base: DataFrame, levels: Sequence[str], sums: Sequence[str], count_name: str = "fact_rows") -> DataFrame:
    """ROLLUP of rows that are added up by ``levels`` already."""
    return base.rollup(*levels).agg(
        *[F.sum(m).alias(m) for m in sums],
        F.sum(count_name).alias(count_name),
        F.grouping_id().alias("grouping_level"),
    )


def rollup_fact(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str, Sequence[tuple[str, Column]]]],
    levels: Sequence[str],
    sums: Sequence[str],
    count_name: str = "fact_rows",
    sampled: DataFrame | None = None,
) -> DataFrame:
    """Roll the fact up by dimension attributes (E2, E4); ``sampled``: see ``level_rows``.

    The attributes are joined to the fact (broadcast where the dimension was
    measured to fit), the levels are aggregated with partial sums in every
    task, and only that small result is expanded by the ROLLUP.
    """
    rows = level_rows(fact, dims, sampled)
    base = rows.groupBy(*levels).agg(*[F.sum(m).alias(m) for m in sums], F.count(F.lit(1)).alias(count_name))
    return rollup_levels(base, levels, sums, count_name)
