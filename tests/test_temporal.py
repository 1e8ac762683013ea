"""As-of lookups: every path against plain Python, one row out for each row in."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starweave.operators import history, keys, temporal
from starweave.plans.facts import KeyLookup, resolve_keys

T0 = datetime(2020, 1, 1)
DIM = "tk long, date_from timestamp_ntz, date_to timestamp_ntz, k string, g int"
FACT = "n long, key string, grp int, at timestamp_ntz, tk string"


def brute(facts, dim):
    out = {}
    for n, key, grp, at, _ in facts:
        begun = [v for v in dim if None not in (key, grp, at) and v[3] == key and v[4] == grp and (v[1] is None or v[1] <= at)]
        last = max(begun, key=lambda v: (v[1] is not None, v[1] or T0, v[0]), default=None)
        out[n] = last[0] if last and (last[2] is None or at < last[2]) else 0
    return out


def case(seed, n=600):
    rnd = random.Random(seed)
    day = lambda: T0 + timedelta(days=rnd.randrange(40))
    dim, tk = [], 0
    for k in "abcdef":
        for g in (1, 2):
            at = None if rnd.random() < 0.3 else day()
            for _ in range(rnd.randrange(6)):
                end = (at or T0) + timedelta(days=rnd.randrange(9))
                tk += 1
                dim.append((tk, at, None if rnd.random() < 0.1 else end, k, g))
                at = end + timedelta(days=rnd.choice([0, 0, 0, 3]))  # gaps, and versions of no length
    dim.append((tk + 1, T0, None, None, 1))
    facts = []
    for i in range(n):
        hot = rnd.random() < 0.5
        at = rnd.choice([T0 + timedelta(days=17), day(), day()]) if hot else day()
        facts.append((i, "a" if hot else rnd.choice([*"abcdefg", None]), 1 if hot else rnd.choice([1, 2, None]), None if rnd.random() < 0.05 else at, "x"))
    return facts, dim


def result(spark, facts, dim, **how):
    f, v = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    got = temporal.as_of_lookup(f, v, [("key", "k"), ("grp", "g")], "at", "tk", out="found", **how)
    assert got.columns == [*f.columns, "found"]
    rows = got.collect()
    assert len(rows) == len(facts) and all(tuple(r)[:5] == facts[r.n] for r in rows)
    return {r.n: r.found for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_both_paths_against_plain_python(spark, seed):
    facts, dim = case(seed)
    want = brute(facts, dim)
    assert len(set(want.values())) > 8 and 0 in want.values()
    assert result(spark, facts, dim, broadcast=True) == want
    assert result(spark, facts, dim, broadcast=False) == want


@pytest.mark.parametrize("slices", [2, 7, 32])
def test_hot_keys_are_cut_by_time(spark, slices, monkeypatch):
    facts, dim = case(9, 900)
    f = spark.createDataFrame(facts, FACT)
    rows = f.select(F.col("key").alias("_sw_k0"), F.col("grp").alias("_sw_k1"), "at")
    hot = temporal.hot_slices(rows, ["_sw_k0", "_sw_k1"], "at", slices=slices, fraction=1.0)
    cuts = {r._sw_json: r._sw_cuts for r in hot.collect()}
    assert cuts and all(len(c) == slices - 1 for c in cuts.values())
    assert result(spark, facts, dim, broadcast=False, hot=hot) == brute(facts, dim)
    # the common instant is a cut more than once, and its rows lie in several tasks
    v = spark.createDataFrame(dim, DIM)
    if slices == 32:
        seen = []
        window = temporal.Window.partitionBy
        monkeypatch.setattr(temporal.Window, "partitionBy", staticmethod(lambda *c: seen.append(c) or window(*c)))
        temporal.as_of_lookup(f, v, [("key", "k"), ("grp", "g")], "at", "tk", out="found", broadcast=False, hot=hot)
        assert "_sw_slice" in seen[0]
        assert max(c.count(T0 + timedelta(days=17)) for c in cuts.values()) > 1


def test_the_fact_is_shuffled_once_and_never_by_a_range(spark):
    facts, dim = case(1)
    f, v = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    none = spark.createDataFrame([], "_sw_json string, _sw_cuts array<timestamp_ntz>")
    plan = temporal.as_of_lookup(f, v, [("key", "k"), ("grp", "g")], "at", "tk", out="found", broadcast=False, hot=none)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("hashpartitioning") == 1


def test_a_merged_dimension_does_not_multiply_the_fact(spark):
    cur = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    cols = ["tk", "version", "date_from", "date_to", "k", "v"]
    dim = keys.scd1_columns(keys.surrogate_key(cur, ["k"], "tk"), "2023-01-01 00:00:00").select(*cols)
    dim = history.scd2_merge(dim, spark.createDataFrame([("a", 9), ("c", 3)], "k string, v int"), ["k"], ["v"], "tk", "2024-01-01 00:00:00")
    st = spark.createDataFrame([(1, "a", datetime(2023, 5, 1)), (2, "a", datetime(2024, 1, 1)), (3, "c", datetime(2023, 5, 1)), (4, "A ", datetime(2025, 1, 1)), (5, "a", datetime(2022, 1, 1))], "n int, key string, at timestamp_ntz")
    as_of = resolve_keys(st, [KeyLookup(dim, "tk", (("key", "k"),), normalize=True, at="at")], ["n"])
    assert sorted(map(tuple, as_of.collect())) == [(0, 3), (0, 5), (1, 1), (3, 2), (3, 4)]
    # without a time the open version counts
    now = resolve_keys(st, [KeyLookup(dim, "tk", (("key", "k"),), normalize=True)], ["n"])
    assert sorted(map(tuple, now.collect())) == [(3, 1), (3, 2), (3, 4), (3, 5), (4, 3)]


def test_empty_sides(spark):
    facts, dim = case(2, 20)
    f, v = spark.createDataFrame(facts, FACT), spark.createDataFrame(dim, DIM)
    for way in (True, False):
        assert {r.found for r in temporal.as_of_lookup(f, v.limit(0), [("key", "k")], "at", "tk", out="found", broadcast=way).collect()} == {0}
        assert temporal.as_of_lookup(f.limit(0), v, [("key", "k")], "at", "tk", out="found", broadcast=way).collect() == []
