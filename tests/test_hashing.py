"""Seeded numbers are the same in Spark and in SQL engines (md5 hex digits)."""

import duckdb
from pyspark.sql import functions as F

from starweave.functions.hashing import hash60, hash_int, hash_mod
from starweave.plans.oracle import h, h60


def test_spark_and_duckdb_agree(spark):
    df = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 3).alias("j"))
    got = [tuple(r) for r in df.select(
        "k", hash_int(1, "t", "k", "j").alias("a"), hash60(7, "k").alias("b"), hash_mod(1, "deaths", 10000, "k").alias("c")
    ).orderBy("k").collect()]
    con = duckdb.connect()
    want = con.execute(
        f"SELECT k, {h(1, 't', ['k', 'j'])}, {h60(7, ['k'])}, {h(1, 'deaths', ['k'])} % 10000 "
        "FROM (SELECT range AS k, range * 3 AS j FROM range(50)) ORDER BY k"
    ).fetchall()
    assert got == [tuple(r) for r in want]
    assert all(0 <= r[1] < 2**32 and 0 <= r[2] < 2**60 for r in got)
