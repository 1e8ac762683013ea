from pyspark.sql import functions as F

from starweave.llm import common as C


def test_bounded_sample(spark):
    rows = spark.range(0, 20000).select(F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("g"), F.col("id"), F.lit(0).alias("other"))
    got = C.bounded_sample(rows, "g", ["id"], 100).collect()
    assert sorted(r.g for r in got) == ["a"] * 100 + ["b"] * 100
    again = C.bounded_sample(rows.repartition(7), "g", ["id"], 100).collect()
    assert {(r.g, r.id) for r in got} == {(r.g, r.id) for r in again}
    few = C.bounded_sample(rows.where("id < 30").union(rows.where("id < 30")), "g", ["id"], 100)
    assert few.count() == 30


def test_bounded_sample_counts_ids_not_rows(spark):
    rows = spark.range(0, 1000).select(F.lit("a").alias("g"), "id").union(spark.range(0, 200000).select(F.lit("a").alias("g"), F.lit(7).cast("long").alias("id")))
    got = {r.id for r in C.bounded_sample(rows, "g", ["id"], 100).collect()}
    assert len(got) == 100
    assert got == {r.id for r in C.bounded_sample(rows.distinct(), "g", ["id"], 100).collect()}


def test_pieces_are_the_whole_text():
    for text in ("", "a b c", "x" * 50, "word " * 30, "a\n" + "b" * 25 + " c"):
        for size in (7, 10, 1000):
            parts = list(C.pieces(text, size))
            assert "".join(parts) == text and all(len(p) <= size for p in parts)


def test_connected_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 299)]
    got = {r.node: r.component for r in C.connected(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 140)} | {300: 299}
    assert C.connected(spark.createDataFrame([], "u long, v long"), "t").collect() == []


def test_named_rows_go_or_get_their_value_whatever_their_number(spark, make_docs, monkeypatch):
    from starweave.llm import common as C

    rows = [(i if i % 7 else None, f"text {i % 40}") for i in range(300)] + [(3, None), (None, None), (4, "")]
    docs = make_docs(rows)
    named = docs.where("doc_id % 3 = 0 or (doc_id is null and text like '%5')").select(F.col("doc_id").alias("i"), C.text_key(F.col("text")).alias("k")).distinct()
    valued = named.withColumn("v", F.array(F.lit(1), F.lit(2)))
    gone = {(r[0], r[1] or "") for r in rows if (r[0] is not None and r[0] % 3 == 0) or (r[0] is None and (r[1] or "").endswith("5"))}
    for limit in (C.BROADCAST_ROWS, -1):
        monkeypatch.setattr(C, "BROADCAST_ROWS", limit)
        left = C.without(docs, named, "i", "k")
        key = lambda r: str(r)
        assert left.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in left.collect()), key=key) == sorted((r for r in rows if (r[0], r[1] or "") not in gone), key=key)
        got = C.with_named(docs, valued, "i", "k", "v").collect()
        assert sorted(((r.doc_id, r.text, r.v) for r in got), key=key) == sorted(((*r, [1, 2] if (r[0], r[1] or "") in gone else None) for r in rows), key=key)


def test_batches_are_small(spark):
    from starweave.llm.common import BATCH_ROWS, map_batches

    def count(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    df = spark.range(0, 5 * BATCH_ROWS, 1, 1)
    sizes = map_batches(df, count, "n long")
    assert [r.n for r in sizes.collect()] == [BATCH_ROWS] * 5
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "123")  # a session's own size stays
        map_batches(df, lambda batches: batches, "id long")
        assert spark.conf.get(key) == "123"
    finally:
        spark.conf.set(key, old)
