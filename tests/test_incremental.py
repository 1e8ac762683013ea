"""Facts that are kept up to date: delta roll-ups, replaced partitions, tables in buckets."""

import os
import random
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starweave.operators import history
from starweave.operators.colocated import Colocated, colocated_lookup
from starweave.operators.rollup_store import RollupStore
from starweave.plans import catalog
from starweave.sources import partitioned

D = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()  # the final plan
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------- roll-ups


def facts(spark, data):
    return spark.createDataFrame(data, "a string, b int, deaths int")


def plain(spark, data):
    base = facts(spark, data).groupBy("a", "b").agg(F.sum("deaths").alias("deaths"), F.count("*").alias("fact_rows"))
    return rows(history.rollup_levels(base, ["a", "b"], ["deaths"]))


def test_rollup_follows_inserts_and_corrections(spark, tmp_path):
    rnd = random.Random(3)
    store, live = RollupStore(spark, str(tmp_path / "r"), "a string, b int", ["deaths"]), []
    assert rows(store.totals()) == []
    for i in range(6):
        added = [(rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2]), rnd.randrange(-3, 9)) for _ in range(40)]
        removed = [live.pop(rnd.randrange(len(live))) for _ in range(min(len(live), 25))]
        live += added
        assert store.apply(f"load {i}", facts(spark, added), facts(spark, removed) if removed else None)
        assert not store.apply(f"load {i}", facts(spark, added), facts(spark, removed) if removed else None)
        if i in (2, 4):
            assert store.compact()
        assert rows(store.rollup()) == plain(spark, live)
    assert store.apply("all", removed=facts(spark, live)) and rows(store.totals()) == []
    with pytest.raises(ValueError):
        store.apply("nothing")


def test_a_level_that_cancels_out_keeps_its_rows(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path / "r"), "a string, b int", ["deaths"])
    store.apply("1", facts(spark, [("x", 1, 5), ("x", 1, -5), ("y", 1, 0)]))
    assert rows(store.totals()) == [("x", 1, 0, 2), ("y", 1, 0, 1)]
    store.apply("2", removed=facts(spark, [("x", 1, 5)]))
    assert rows(store.totals()) == [("x", 1, -5, 1), ("y", 1, 0, 1)]


def test_writers_at_once_and_a_compaction_between(spark, tmp_path):
    stores = [RollupStore(spark, str(tmp_path / "r"), "a string, b int", ["deaths"]) for _ in range(3)]
    done = stores[0].log.entries()
    attempt = stores[0]._write(stores[0]._live(done))  # a compaction that read the log before the loads came
    threads = [threading.Thread(target=s.apply, args=(f"{i}", facts(spark, [("x", i, 1)]))) for i, s in enumerate(stores)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not stores[0].log.put(len(done), {"load_id": "compact", "attempt": attempt, "whole": True})
    assert rows(stores[0].totals()) == [("x", i, 1, 1) for i in range(3)]
    assert stores[0].compact() and rows(stores[1].totals()) == [("x", i, 1, 1) for i in range(3)]


# ------------------------------------------------------------- partitions


def month_files(path):
    return {m: sorted(f for f in os.listdir(f"{path}/{m}") if f.endswith(".parquet")) for m in os.listdir(path) if "=" in m}


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "f")
    df = spark.range(600).select("id", (F.col("id") % 6 + 199801).cast("int").alias("m"))
    partitioned.overwrite_partitions(df, path, ["m"])
    before = month_files(path)
    partitioned.overwrite_partitions(df.filter("m = 199803").withColumn("id", -F.col("id")), path, ["m"])
    after = month_files(path)
    assert {k for k in before if before[k] != after[k]} == {"m=199803"}
    back = partitioned.read_partitioned(spark, path, df)
    assert back.filter("id < 0").count() == 100 and back.count() == 600
    partitioned.overwrite_partitions(df.limit(0), path, ["m"])
    assert month_files(path) == after


def test_a_common_date_is_split_over_tasks(spark, tmp_path):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(F.col("id") % 3 < 2, 199801).otherwise(199802 + F.col("id") % 4).cast("int").alias("m"))
        partitioned.overwrite_partitions(df, str(tmp_path / "f"), ["m"])
        assert len(month_files(str(tmp_path / "f"))["m=199801"]) > 5
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_calendar_prunes_the_fact_at_run_time(spark, tmp_path):
    path = str(tmp_path / "f")
    ln = spark.read.parquet(f"{D}/lineitem.parquet").withColumn("ship_month", partitioned.month_key("l_shipdate"))
    partitioned.overwrite_partitions(ln, path, ["ship_month"])
    fact = partitioned.read_partitioned(spark, path, ln)
    report = catalog.month_report(fact, ln)
    scan = next(x for x in plan_of(report).splitlines() if "FileScan" in x and "PartitionFilters" in x and "dynamicpruning" in x)
    assert "ship_month" in scan and "l_orderkey" not in scan.split("ReadSchema")[1]


def test_null_dates_have_a_partition_too(spark, tmp_path):
    df = spark.createDataFrame([("1998-01-05", 1), (None, 2)], "d string, n int").select(F.to_date("d").alias("d"), "n").withColumn("m", partitioned.month_key("d"))
    partitioned.overwrite_partitions(df, str(tmp_path / "f"), ["m"])
    assert [(r.n, r.m) for r in partitioned.read_partitioned(spark, str(tmp_path / "f"), df).orderBy("n").collect()] == [(1, 199801), (2, None)]


# ------------------------------------------------------------- buckets


def test_bucketed_tables_join_without_an_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(5_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 700).alias("k"), F.col("id").cast("string").alias("s"))
        dim = spark.range(600).select((F.col("id") + 1).alias("tk"), F.col("id").alias("key"))
        f, g = Colocated(fact, "fact", ["k"], 8), Colocated(dim, "dim", ["key"], 8)
        out = colocated_lookup(f, g, "tk")
        plan = plan_of(out)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = [(i, k, str(i), k + 1 if k is not None and k < 600 else 0) for i in range(5_000) for k in [i % 700 if i % 3 > 0 else None]]
        assert sorted(map(tuple, out.collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tables_bucketed_otherwise_are_refused(spark):
    f = Colocated(spark.range(5).withColumnRenamed("id", "k"), "fact", ["k"], 8)
    for other in (Colocated(spark.range(5).withColumnRenamed("id", "k"), "dim", ["k"], 4), Colocated(spark.range(5).select(F.col("id").cast("int").alias("k")), "dim", ["k"], 8)):
        with pytest.raises(ValueError, match="not bucketed alike"):
            colocated_lookup(f, other, "k")
