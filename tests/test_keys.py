from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from starweave.operators import keys


def test_dense_number_range_path_equals_global_window(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("k"), (F.col("id") % 11).alias("v"), F.col("id"))
    ranged = keys.dense_number(df, ["k", "v"], "rn", tie=["id"], partitions=7)
    plain = keys.global_number(df, ["k", "v", "id"], "rn")
    assert rows(ranged.select("k", "v", "id", "rn")) == rows(plain.select("k", "v", "id", "rn"))
    got = sorted(r.rn for r in ranged.select("rn").collect())
    assert got == list(range(1, 5001))


def test_dense_number_hot_identical_rows_spread(spark):
    # a third of all rows are one identical tuple; numbers stay dense and unique
    hot = spark.range(0, 3000).select(F.lit(1).alias("k"), F.lit("x").alias("a"))
    cold = spark.range(0, 6000).select((F.col("id") + 2).alias("k"), F.lit("y").alias("a"))
    df = hot.unionByName(cold).withColumn("rid", F.monotonically_increasing_id())
    out = keys.dense_number(df, ["k", "a"], "rn", tie=["rid"], partitions=8)
    got = sorted(r.rn for r in out.select("rn").collect())
    assert got == list(range(1, 9001))
    hot_rns = sorted(r.rn for r in out.filter("k = 1").select("rn").collect())
    assert hot_rns == list(range(1, 3001))


def test_dense_number_nulls_first_and_start(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",)], "k string")
    out = keys.dense_number(df, ["k"], "tk", start=1, partitions=2)
    assert rows(out) == rows(spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, tk long"))


def test_dense_number_of_a_small_input_needs_no_offsets(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert rows(keys.dense_number(df, ["k"], "rn")) == [(i, i + 1) for i in range(1000)]


def test_a_counted_fixed_width_input_that_fits_one_range_is_not_written(spark, monkeypatch):
    from starweave.sources import files

    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    monkeypatch.setattr(files, "materialize", None)
    assert rows(keys.dense_number(df, ["k"], "rn", at_most=1000)) == [(i, i + 1) for i in range(1000)]
    assert keys.fixed_bytes(df.withColumn("s", F.lit("text")), 1000) is None
    assert keys.range_partitions(spark, keys.fixed_bytes(df, 100_000_000)) > 1


def test_dedup_keeps_source_rank_then_attributes_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, 1), (1, "b", 1), (1, "z", 0), (2, None, 0), (2, "a", 0), (3, None, 0)],
        "k int, a string, src int",
    )
    out = keys.first_by_attributes(df, ["k"], rank_col="src")
    assert rows(out) == [(1, "z", 0), (2, "a", 0), (3, None, 0)]


def test_dedup_deterministic_across_partitionings(spark):
    base = spark.range(0, 2000).select((F.col("id") % 50).alias("k"), (F.col("id") * 13 % 97).alias("a"))
    outs = []
    for n in (1, 4, 17):
        shuffled = base.repartition(n).orderBy(F.rand(n))
        outs.append(rows(keys.first_by_attributes(shuffled, ["k"])))
    assert outs[0] == outs[1] == outs[2]


def test_unknown_member_and_scd_columns(spark):
    dim = spark.createDataFrame([("a", True), ("b", False)], "name string, flag boolean")
    keyed = keys.surrogate_key(dim, ["name"], "tk")
    scd = keys.scd1_columns(keyed, "2024-01-01 00:00:00")
    full = keys.with_unknown_member(scd.select("tk", "version", "date_from", "date_to", "name", "flag"),
                                    {"tk": 0, "version": 1, "date_from": "2024-01-01 00:00:00", "flag": False})
    got = rows(full)
    ts = datetime(2024, 1, 1)
    assert got == [(0, 1, ts, None, None, False), (1, 1, ts, None, "a", True), (2, 1, ts, None, "b", False)]
    assert dict(full.dtypes)["date_from"] == "timestamp_ntz"


def test_reserved_label_removed_before_unknown(spark):
    df = spark.createDataFrame([("UNKNOWN",), ("A",)], "k string")
    assert rows(keys.without_reserved(df, ["k"], {"k": "UNKNOWN"})) == [("A",)]
