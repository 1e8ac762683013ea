from llm import brute
import numpy as np
import pytest
from pyspark.sql import types as T

from starweave.llm import topk as K
from starweave.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def got(df, **kw):
    return sorted(tuple(r) for r in K.query(df, **kw).collect())


@pytest.mark.parametrize("block,queries", [(2048, 512), (37, 3)])
def test_whole_table_equals_brute_force(spark, rows_of, monkeypatch, block, queries):
    monkeypatch.setattr(K, "BLOCK", block)
    monkeypatch.setattr(K, "QUERIES", queries)
    rows = rows_of("embeddings")
    assert got(table(spark, "/root/testdata/sf0.001", "embeddings")) == brute.top_k(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, -1.0]), (2, [0.5, 3.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (None, [1.0, 1.0]), (7, [1.0]), (50, [0.0, 0.0]), (100, [1.0]), (150, []), (8, []), (200, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 AS row", "2 AS dims", "3 AS score", "4 AS v")
    assert got(df) == brute.top_k([{"vec_id": i, "embedding": v} for i, v in rows])


def test_ties_and_common_vectors(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [0.25, -0.5, 1.0] if i % 3 == 0 else [float(x) for x in np.round(rng.normal(size=3), 1)]) for i in range(200)]
    assert got(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)) == brute.top_k([{"vec_id": i, "embedding": v} for i, v in rows])


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0], 0), (1, [1.0], 0), (1, [1.0], 0), (2, [3.0], 0)], SCHEMA)
    assert [(r[2], r[3]) for r in got(df)] == [(2, 3 * 65536), (1, 65536), (1, 65536)]
    assert got(spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))) == []


def test_bounds_never_lose_a_winner_and_stop_early():
    rng = np.random.default_rng(2)
    v = rng.integers(-60, 60, (1000, 16))
    lists = K.sorted_lists(v)
    early = 0
    for q in rng.integers(-60, 60, (40, 16)):
        s = v @ q
        kth = np.sort(s)[-5]
        for floor in (-np.inf, kth - 1, kth):
            at = K.nra(q, lists, len(v), 5, floor)
            assert set(np.flatnonzero(s >= max(kth, floor))) <= set(at)
        early += len(at) < 500
    assert early > 30  # of 40 queries, with the floor of the last round


def test_cells_are_bounded_and_grow_with_the_work():
    assert K.grid(0, 0, 0) == (1, 1) and K.grid(26, 3, 64) == (1, 26)
    for blocks, asks, dims in ((100, 1, 64), (5000, 40, 64), (10**6, 80000, 64), (10**4, 200, 1024)):
        groups, slots = K.grid(blocks, asks, dims)
        most = max(1, K.CELL * K.WIDE // max(K.WIDE, dims))
        assert -(-blocks // slots) <= most and -(-asks // groups) <= most and groups * slots >= K.MIN_CELLS


def test_more_cells_than_one_for_each_slot(spark, rows_of, monkeypatch):
    for name, value in (("BLOCK", 20), ("QUERIES", 2), ("CELL", 2), ("MIN_CELLS", 4)):
        monkeypatch.setattr(K, name, value)
    rows = rows_of("embeddings")
    groups, slots = K.grid(-(-len(rows) // 20), 5, 64)
    assert groups > 1 and groups * slots > 30
    assert got(table(spark, "/root/testdata/sf0.001", "embeddings")) == brute.top_k(rows)
