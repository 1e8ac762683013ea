"""Staging and fact build with surrogate-key resolution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.functions.text import normalize_key
from starweave.operators.joins import fits_broadcast, hot_keys, lookup_join
from starweave.operators.keys import dense_number, global_number
from starweave.operators.temporal import as_of_lookup

UNKNOWN_TK = 0


@dataclass(frozen=True)
class KeyLookup:
    """Resolve ``tk`` of ``dim`` for each fact row on ``(fact_col, dim_col)`` pairs.

    ``at`` names the row's time: the version of the member valid then is taken (type 2).
    Without it the open rows count (``date_to`` null), one for each natural key.
    """

    dim: DataFrame
    tk: str
    on: tuple[tuple[str, str], ...]
    normalize: bool = False
    at: str | None = None


def stage_fact(sources: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Staging fact: UNION ALL by name of the sources."""
    out = None
    for src in sources:
        part = src.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def resolve_keys(
    staging: DataFrame,
    lookups: Sequence[KeyLookup],
    keep: Sequence[str],
    unknown_tk: int = UNKNOWN_TK,
    plain_joins: bool = False,
) -> DataFrame:
    """Left-join every lookup; unmatched keys resolve to the UNKNOWN member.

    Left joins never drop a staging row; each dimension side is reduced to its
    key and tk (the natural key is unique in a built dimension, so no row is
    duplicated either). A dimension is broadcast if its measured size fits; for
    the others, one sample of the staging rows finds the hot keys of all lookups
    (left joins to unique keys don't change them). Lookups with a time (``at``) find the
    version valid then, see ``temporal.as_of_lookup``.
    """
    shuffled = {}
    for i, lk in enumerate(lookups):
        if not lk.at and not fits_broadcast(lk.dim):
            shuffled[str(i)] = [normalize_key(f) if lk.normalize else F.col(f) for f, _ in lk.on]
    hot = {} if plain_joins else hot_keys(staging, shuffled)
    out = staging
    tks = []
    for i, lk in enumerate(lookups):
        tks.append((f"_sw_tk{i}", lk.tk))
        if lk.at:
            pairs = [tuple(normalize_key(c) if lk.normalize else F.col(c) for c in pair) for pair in lk.on]
            out = as_of_lookup(out, lk.dim, pairs, lk.at, lk.tk, out=f"_sw_tk{i}", unknown_tk=None)
            continue
        dim_cols = {d: f"_sw_l{i}_{j}" for j, (_, d) in enumerate(lk.on)}
        open_rows = lk.dim.filter(F.col("date_to").isNull()) if "date_to" in lk.dim.columns else lk.dim
        side = open_rows.select(
            F.col(lk.tk).alias(f"_sw_tk{i}"),
            *[(normalize_key(d) if lk.normalize else F.col(d)).alias(n) for d, n in dim_cols.items()],
        )
        on = [(normalize_key(f) if lk.normalize else F.col(f), dim_cols[d]) for f, d in lk.on]
        if plain_joins:
            out = out.join(side, [key == F.col(c) for key, c in on], "left")
        else:
            out = lookup_join(out, side, on, broadcast=str(i) not in shuffled, hot=hot.get(str(i)))
    return out.select(
        *[F.coalesce(F.col(src), F.lit(unknown_tk)).cast("bigint").alias(name) for src, name in tks],
        *[F.col(c) for c in keep],
    )


def build_fact(
    staging: DataFrame,
    lookups: Sequence[KeyLookup],
    measures: Sequence[str],
    fact_tk: str,
    row_id: Sequence[str] = (),
    at_most: int | None = None,
    global_window: bool = False,
    plain_joins: bool = False,
) -> DataFrame:
    """FK-resolved fact numbered 1..n by (all tks, measures).

    The numbering writes the resolved rows (tks, measures, row id: narrow
    columns) before it range-partitions them, so staging and lookups run once; for
    ``at_most``, the staging rows if they were counted, see ``dense_number``.

    ``row_id`` columns identify staging rows; they only split ties between
    otherwise identical rows (so a hot duplicate spreads over partitions) and
    are dropped from the result. ``global_window`` (one task numbers all) and
    ``plain_joins`` are for comparison on small data only.
    """
    resolved = resolve_keys(staging, lookups, [*measures, *row_id], plain_joins=plain_joins)
    order = [lk.tk for lk in lookups] + list(measures)
    if global_window:
        return global_number(resolved, [*order, *row_id], fact_tk).select(*order, fact_tk)
    numbered = dense_number(resolved, order, fact_tk, tie=list(row_id), at_most=at_most)
    return numbered.select(*order, fact_tk)
