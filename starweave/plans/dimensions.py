"""Generic conformed-dimension build.

One function replaces a hand-written script per dimension:
sources (ranked) -> union -> drop NULL keys -> one row per natural key ->
surrogate key -> SCD columns -> fixed column order -> UNKNOWN member.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.operators.clean import drop_null_keys
from starweave.operators.keys import (
    first_by_attributes,
    global_number,
    scd1_columns,
    surrogate_key,
    with_unknown_member,
    without_reserved,
)
from starweave.operators.registry import KeyRegistry
from starweave.sources.files import materialize

SCD_COLUMNS = ("version", "date_from", "date_to")


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    tk: str
    natural_key: tuple[str, ...]
    attributes: tuple[str, ...]
    column_order: tuple[str, ...] | None = None
    unknown: Mapping[str, object] = field(default_factory=dict)
    reserved: Mapping[str, object] | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return self.column_order or (*self.natural_key, *self.attributes)


def union_sources(sources: Sequence[DataFrame], cols: Sequence[str], rank_col: str = "_sw_src") -> DataFrame:
    """UNION ALL by name of same-entity sources, tagged with their rank.

    Rank 0 (the first source) wins ties in the dedup that follows.
    """
    out = None
    for i, src in enumerate(sources):
        part = src.select(*cols).withColumn(rank_col, F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out


def dedup_sources(sources: Sequence[DataFrame], spec: DimensionSpec) -> DataFrame:
    """Union, drop NULL keys, keep the first row per natural key (G1)."""
    staged = union_sources(sources, [*spec.natural_key, *spec.attributes])
    staged = drop_null_keys(staged, spec.natural_key)
    return first_by_attributes(staged, spec.natural_key, rank_col="_sw_src").drop("_sw_src")


def build_dimension(
    sources: Sequence[DataFrame],
    spec: DimensionSpec,
    load_ts: datetime | str,
    at_most: int | None = None,
    global_window: bool = False,
    registry: KeyRegistry | None = None,
    load_id: str | None = None,
) -> DataFrame:
    """Conformed dimension with surrogate key, SCD columns and an UNKNOWN member.

    The numbering writes the deduplicated members first, so the sources are
    scanned once (see ``dense_number`` for ``at_most``, the rows of all sources). ``global_window`` numbers them in a single task instead (for
    comparison on small data only). With a ``registry`` members keep the key that they had
    at earlier loads, and only new ones are numbered, once for each ``load_id``.
    """
    one = dedup_sources(sources, spec)
    if spec.reserved:
        one = without_reserved(one, spec.natural_key, spec.reserved)
    if registry is not None:
        if load_id is None:
            raise ValueError("a registered load needs an id, so that a second try of it adds no keys")
        one = materialize(one, f"{spec.name}-members")  # read twice: for its keys and for its attributes
        registry.extend(load_id, one)
        keyed = registry.keyed(one)
    elif global_window:
        keyed = global_number(one, spec.natural_key, spec.tk)
    else:
        keyed = surrogate_key(one, spec.natural_key, spec.tk, at_most=at_most)
    dim = scd1_columns(keyed, load_ts).select(spec.tk, *SCD_COLUMNS, *spec.columns)
    unknown = {spec.tk: 0, "version": 1, "date_from": load_ts, **spec.unknown}
    return with_unknown_member(dim, unknown)
