from conftest import rows
from pyspark.sql import functions as F

from starweave.session import shared_path
from starweave.sources import files, jdbc


def test_csv_roundtrip_keeps_leading_zeros(spark):
    df = spark.createDataFrame([("01001", 1.5), ("99999", None)], "code string, v double")
    p = shared_path(spark, "t-csv")
    files.write_csv(df, p)
    assert rows(files.read_csv(spark, p, schema="code string, v double")) == rows(df)
    inferred = files.read_csv(spark, p, infer=True)
    assert dict(inferred.dtypes)["code"] == "int"


def test_jdbc_overwrite_truncate_append_and_partitioned_read(spark):
    url, props = jdbc.derby_memory(spark, "t_sw_jdbc", "/dev/null")
    df = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("v"))
    jdbc.write_jdbc(df, url, "t1", props, mode="overwrite")
    jdbc.write_jdbc(df, url, "t1", props, mode="overwrite", truncate=True)
    jdbc.write_jdbc(df.limit(10), url, "t1", props, mode="append")
    back = jdbc.read_jdbc(spark, url, "t1", props, partition_column="k", num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 110


def test_materialize_cuts_lineage(spark):
    df = spark.range(0, 10).withColumn("x", F.col("id") * 2)
    m = files.materialize(df, "t-mat")
    assert rows(m) == rows(df)
    assert "FileScan parquet" in m._jdf.queryExecution().executedPlan().toString()


def test_large_intermediates_are_written_densely_and_sides_are_not(spark):
    import re

    from starweave.operators import keys
    from starweave.plans import scenario as S

    d = "/root/testdata/sf0.01"
    numbered = keys.dense_number(spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")), ["k"], "n", partitions=4)
    names = lambda df: {re.search(r"\.(\w+)\.parquet$", f)[1] for f in df.inputFiles()}
    assert names(S.lines(spark, d)) == names(numbered) == {"zstd"}
    assert names(S.customers(spark, d)) == names(files.materialize(spark.range(9), "t-plain")) == {"snappy"}


def test_row_count_observed_during_write(spark):
    from starweave.operators.metrics import write_observed

    df = spark.range(0, 1234)
    p = shared_path(spark, "t-obs")
    got = write_observed(df, lambda d: d.write.parquet(p), "w")
    assert got == {"rows": 1234}
    assert spark.read.parquet(p).count() == 1234


def test_table_from_contract(spark):
    from pyspark.sql import types as T

    from starweave.operators.constraints import create_table_if_missing

    contract = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType())])
    create_table_if_missing(spark, "sw_state_contract", contract, path=shared_path(spark, "t-contract"))
    create_table_if_missing(spark, "sw_state_contract", contract)
    assert [f.name for f in spark.table("sw_state_contract").schema.fields] == ["id", "name"]
