"""Bloom filters: no key is lost, few others pass, and the anti-join's result is the same with and without."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starweave.operators import bloom, joins
from starweave.sources.files import materialize


def test_no_key_is_lost_and_few_others_pass(spark):
    keys = spark.range(20_000).select((F.col("id") * 7).alias("a"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("b"))
    others = spark.range(200_000).select((F.col("id") * 7 + 1).alias("a"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("b"))
    assert bloom.pruned(keys, ["a", "b"], keys, ["a", "b"], 20_000).count() == 20_000
    assert bloom.pruned(others, ["a", "b"], keys, ["a", "b"], 20_000).count() < 0.01 * 200_000


def test_size_follows_the_count():
    assert bloom.size_for(0) == bloom.MIN_BITS and bloom.size_for(1_000_000) == 1 << 24
    assert bloom.size_for(1 << 24) == bloom.MAX_BITS and bloom.size_for((1 << 24) + 1) is None


def test_filters_merge(spark):
    df = spark.range(3_000).select(F.col("id").alias("k"))
    bits = 1 << 16
    a, b = (bloom.bloom_filter(df.where(F.col("k") % 2 == i), ["k"], bits) for i in (0, 1))
    assert bloom.merged(a, b).first() == bloom.bloom_filter(df, ["k"], bits).first()
    with pytest.raises(Exception, match="different sizes"):
        bloom.merged(a, bloom.bloom_filter(df, ["k"], 2 * bits)).collect()


def test_nulls_are_keys(spark):
    df = spark.createDataFrame([(None, "x"), (1, None), (2, "y")], "a int, b string")
    assert bloom.pruned(df, ["a", "b"], df, ["a", "b"], 3).count() == 3
    assert rows(bloom.pruned(df, ["a", "b"], df.limit(0), ["a", "b"], 0)) == []


def test_types_whose_hashes_do_not_follow_equality_are_not_filtered(spark):
    ints, longs, doubles = spark.range(9).select(F.col("id").cast("int").alias("k")), spark.range(3).withColumnRenamed("id", "k"), spark.sql("SELECT -0.0D AS k")
    assert bloom.pruned(ints, ["k"], longs, ["k"], 3) is ints
    assert bloom.pruned(doubles, ["k"], doubles, ["k"], 1) is doubles
    assert bloom.pruned(longs, ["k"], longs, ["k"], None) is longs


@pytest.mark.parametrize("forced", [False, True])
def test_the_anti_join_is_the_same(spark, forced, monkeypatch):
    rnd = random.Random(4)
    pick = lambda n, top: [(rnd.choice([None, *range(top)]), rnd.choice([None, "a", "b"])) for _ in range(n)]
    incoming, existing = pick(300, 400), pick(2_000, 900)
    df = materialize(spark.createDataFrame(incoming, "k int, s string"), "incoming")
    ex = materialize(spark.createDataFrame(existing, "k int, s string"), "existing")
    if forced:
        spark.conf.set("spark.starweave.broadcastBytes", "0")
    try:
        out = joins.null_safe_anti(df, ex, ["k", "s"])
        held = set(existing)
        assert rows(out) == sorted((r for r in incoming if r not in held), key=lambda r: tuple((x is None, x) for x in r))
        assert ("NestedLoop" in out._jdf.queryExecution().executedPlan().toString()) == forced
    finally:
        spark.conf.unset("spark.starweave.broadcastBytes")


def test_the_existing_side_is_pruned_before_its_shuffle(spark):
    spark.conf.set("spark.starweave.broadcastBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = materialize(spark.range(100).withColumnRenamed("id", "k"), "incoming")
        ex = materialize(spark.range(50, 300_000).withColumnRenamed("id", "k"), "existing")
        out = joins.null_safe_anti(df, ex, ["k"])
        assert out.count() == 50
        plan = out._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("BroadcastNestedLoopJoin") :]
        assert plan.index("hashpartitioning") < plan.index("BroadcastNestedLoopJoin") and "existing" in below
        assert bloom.pruned(ex, ["k"], df, ["k"], 100).count() < 3_000
    finally:
        spark.conf.unset("spark.starweave.broadcastBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
