from conftest import rows

from starweave.plans.dimensions import DimensionSpec, build_dimension
from starweave.plans.facts import KeyLookup
from starweave.session import shared_path
from starweave.streaming import start_fact_stream

SPEC = DimensionSpec("s", "s_tk", ("name",), ("grp",))


def test_stream_appends_resolved_numbered_batches(spark):
    dim = build_dimension([spark.createDataFrame([("a", 1), ("b", 2)], "name string, grp int")], SPEC, "2024-01-01 00:00:00")
    src, sink, ckpt = shared_path(spark, "src"), shared_path(spark, "sink"), shared_path(spark, "ckpt")
    schema = "name string, deaths int"
    spark.createDataFrame([("a", 1), ("zz", 2)], schema).coalesce(1).write.parquet(src + "/f1")
    lookups = [KeyLookup(dim, "s_tk", (("name", "name"),))]
    q = start_fact_stream(spark, src + "/*", schema, lookups, ["deaths"], "f_tk", sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination(120)
    spark.createDataFrame([("b", 3)], schema).coalesce(1).write.parquet(src + "/f2")
    q = start_fact_stream(spark, src + "/*", schema, lookups, ["deaths"], "f_tk", sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination(120)
    out = spark.read.parquet(sink).select("s_tk", "deaths", "f_tk")
    assert rows(out) == [(0, 2, 1), (1, 1, 2), (2, 3, 3)]
