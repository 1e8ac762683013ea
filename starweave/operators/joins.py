"""Key-resolving joins (J1-J9): broadcast by measured size, salted shuffle joins otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.operators.bloom import pruned
from starweave.sources.files import measured

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# Rows whose join key is NULL can never match; they are spread over this many
# salt values so a mass of NULL keys does not land in one shuffle partition.
NULL_KEY_SALTS = 64
# A non-NULL key holding at least this share of a sample of the fact rows is
# "hot": its rows are spread over HOT_KEY_SALTS salt values and the matching
# dimension rows are replicated once per salt. At most 1/HOT_SHARE keys.
HOT_SHARE = 0.01
HOT_KEY_SALTS = 32
HOT_SAMPLE_FRACTION = 0.001


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("spark.starweave.broadcastBytes", None)
    return int(conf) if conf else DEFAULT_BROADCAST_BYTES


def fits_broadcast(side: DataFrame, limit: int | None = None) -> bool:
    """True if ``side`` was measured while it was written and is under the broadcast limit.

    A side that wasn't measured is not forced either way: Spark's own threshold
    and the sizes that adaptive execution sees decide.
    """
    known = measured(side)
    return known is not None and known[1] <= (limit if limit is not None else broadcast_limit(side))


def hot_keys(
    df: DataFrame, keys: Mapping[str, Sequence[Column | str]], share: float = HOT_SHARE,
    fraction: float = HOT_SAMPLE_FRACTION, seed: int = 17,
) -> dict[str, list[str]]:
    """For each named key (its columns): values, as JSON, with at least ``share`` of a seeded sample of ``df``.

    One job for all keys, and at most 1/share values of each. Used only to
    balance shuffle joins: a missed or extra value changes the work per task,
    never the result.
    """
    if not keys:
        return {}
    sample = df.sample(fraction=fraction, seed=seed)
    each = [F.struct(F.lit(name).alias("name"), key_json(cols).alias("value")) for name, cols in keys.items()]
    exploded = sample.select(F.explode(F.array(*each)).alias("k")).where("k.value is not null").select("k.*")
    # the subtotals of the names come with the counts; they are the largest, so the limit keeps them
    counted = exploded.rollup("name", "value").count().where("name is not null and count > 1")
    top = counted.orderBy(F.desc("count")).limit(len(keys) * (1 + int(1 / share))).collect()
    total = {r["name"]: r["count"] for r in top if r["value"] is None}
    out: dict[str, list[str]] = {name: [] for name in keys}
    for r in top:
        if r["value"] is not None and r["count"] >= share * total[r["name"]]:
            out[r["name"]].append(r["value"])
    return out


def key_json(cols: Sequence[Column | str]) -> Column:
    """The key as text; NULL if any part is."""
    cols = [_as_col(c) for c in cols]
    known = F.lit(True)
    for c in cols:
        known = known & c.isNotNull()
    return F.when(known, F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])))


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[Column | str, str]],
    how: str = "left",
    broadcast: bool | None = None,
    hot: Sequence[str] | None = None,
    salt: str | None = None,
) -> DataFrame:
    """Join ``fact`` to a dimension-like side on ``fact_expr == dim_col`` pairs.

    The fact-side key expressions are computed once into helper columns
    (J2: a normalised key is not re-derived per comparison). ``broadcast``
    says that the side was measured and fits (default: ask ``dim`` itself).
    Otherwise NULL fact keys (which cannot match) carry a salt so they spread
    over partitions, and so do the rows of ``hot`` keys (see ``hot_keys``), whose
    dimension rows are replicated once per salt. Salts come from the row's place
    in its partition, so identical rows spread too; or they are there already, in the
    column ``salt``, if the rows lie by key and salt (see ``distinct_by_key``). AQE's skew-join
    split remains on for the rest.
    """
    names = [f"_sw_k{i}" for i in range(len(on))]
    dnames = [f"_sw_dk{i}" for i in range(len(on))]
    f = fact.withColumns({n: _as_col(expr) for n, (expr, _) in zip(names, on)})
    d = dim.withColumnsRenamed({dc: dn for (_, dc), dn in zip(on, dnames)})
    cond = [F.col(n) == F.col(dn) for n, dn in zip(names, dnames)]
    if fits_broadcast(dim) if broadcast is None else broadcast:
        return f.join(F.broadcast(d), cond, how).drop(*names, *dnames)
    if how == "inner" and not hot and salt is None:
        return f.join(d, cond, how).drop(*names, *dnames)
    place = F.xxhash64(F.monotonically_increasing_id())
    copies = F.array(F.lit(0).cast("bigint"))
    if hot:
        # dimension rows of hot keys are replicated once per salt value (bounded: few keys x salts)
        copies = F.when(key_json(dnames).isin(list(hot)), F.sequence(F.lit(1).cast("bigint"), F.lit(HOT_KEY_SALTS).cast("bigint"))).otherwise(copies)
    f = f.withColumn("_sw_fsalt", salt_of(names, hot, place) if salt is None else F.col(salt))
    d = d.withColumn("_sw_dsalt", F.explode(copies))
    cond.append(F.col("_sw_fsalt") == F.col("_sw_dsalt"))
    return f.join(d, cond, how).drop(*names, *dnames, "_sw_fsalt", "_sw_dsalt")


def salt_of(names: Sequence[str], hot: Sequence[str] | None, place: Column) -> Column:
    """The salt of a row by its key ``names``: 0, but for NULL and hot keys, which ``place`` spreads."""
    any_null = F.lit(False)
    for n in names:
        any_null = any_null | F.col(n).isNull()
    salt = F.when(any_null, F.lit(1) + F.pmod(place, F.lit(NULL_KEY_SALTS)))
    if hot:
        salt = salt.when(key_json(names).isin(list(hot)), F.lit(1) + F.pmod(place, F.lit(HOT_KEY_SALTS)))
    return salt.otherwise(F.lit(0)).cast("bigint")


def distinct_by_key(df: DataFrame, cols: Sequence[str], key: str, hot: Sequence[str], salt: str) -> DataFrame:
    """DISTINCT over ``cols`` whose rows lie by ``key`` and ``salt``, a new column, as a ``lookup_join`` on them needs.

    So that join does not move the rows again. Rows of NULL and hot keys are spread by their
    content. As a mass of equal rows would stay together, theirs are told apart ahead of that, with
    partial sums. ``hot`` should come from a sample of ``df`` itself, which such a mass is in.
    """
    rows = df.select(*cols)
    spread = F.col(key).isNull()
    if hot:
        spread = spread | F.coalesce(key_json([key]).isin(list(hot)), F.lit(False))
    rows = rows.where(~spread).unionByName(rows.where(spread).distinct())
    return rows.withColumn(salt, salt_of([key], hot, F.xxhash64(*cols))).repartition(key, salt).distinct()


def spread_lookup(
    fact: DataFrame, dim: DataFrame, on: Sequence[tuple[Column | str, str]], how: str = "left", broadcast: bool | None = None,
    hot: Sequence[str] | None = None, salt: str | None = None,
) -> DataFrame:
    """``lookup_join`` that looks for the hot keys itself, in a sample, if the side is not broadcast.

    A sample of the end of a plan runs all of it: where a shuffle stands before, ``hot`` tells the keys.
    """
    small = fits_broadcast(dim) if broadcast is None else broadcast
    if hot is None and not small:
        hot = hot_keys(fact, {"key": [f for f, _ in on]})["key"]
    return lookup_join(fact, dim, on, how, small, None if small else hot, salt)


def denormalize(child: DataFrame, parents: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Chain of left joins on same-named FK columns (J1): child ⟕ p1 USING(k1) ⟕ p2 …

    One sample of the child finds the hot keys of all parents that are not broadcast.
    """
    hot = hot_keys(child, {key: [F.col(key)] for parent, key in parents if key in child.columns and not fits_broadcast(parent)})
    out = child
    for parent, key in parents:
        out = lookup_join(out, parent, [(F.col(key), key)], hot=hot.get(key))
    return out


def first_match_ids(table: DataFrame, match_col: str, id_col: str, out: str) -> DataFrame:
    """One id per match value: the smallest, i.e. an explicit "first" (J5, O3).

    Partial aggregation makes the reduction skew-proof.
    """
    return table.groupBy(F.col(match_col).alias("_sw_mv")).agg(F.min(id_col).alias(out))


def first_match_lookup(
    df: DataFrame, value: Column | str, table: DataFrame, match_col: str, id_col: str, out: str
) -> DataFrame:
    """Per row: id of the first ``table`` row whose ``match_col`` equals ``value``, else NULL."""
    ids = first_match_ids(table, match_col, id_col, out)
    return spread_lookup(df, ids, [(_as_col(value), "_sw_mv")], broadcast=fits_broadcast(table))


def null_safe_anti(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no ``existing`` row on ``keys`` (NULL matches NULL).

    If ``df`` was counted while it was written and ``existing`` is not broadcast, a Bloom
    filter of the keys of ``df`` drops other rows of ``existing`` before the shuffle.
    """
    if (known := measured(df)) is not None and not fits_broadcast(existing):
        existing = pruned(existing.select(*keys), keys, df, keys, known[0])
    ex = existing.select(*[F.col(k).alias(f"_sw_e_{k}") for k in keys])
    cond = [df[k].eqNullSafe(ex[f"_sw_e_{k}"]) for k in keys]
    return df.join(F.broadcast(ex) if fits_broadcast(existing) else ex, cond, "left_anti")
