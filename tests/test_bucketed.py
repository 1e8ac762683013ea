"""Merging into a bucketed dimension: the rows of ``scd2_merge``, and untouched files as they were."""

import os
import threading

import pytest
from conftest import rows

from starweave.operators import history, keys
from starweave.operators.bucketed import BucketedDimension

COLS = ["tk", "version", "date_from", "date_to", "k", "v", "w"]


def plain(spark, pairs):
    cur = spark.createDataFrame(pairs, "k string, v int, w string")
    dim = keys.scd1_columns(keys.surrogate_key(cur, ["k"], "tk"), "2023-01-01 00:00:00").select(*COLS)
    return keys.with_unknown_member(dim, {"tk": 0, "version": 1, "k": None})


def start(spark, path, pairs, buckets=16):
    dim = plain(spark, pairs)
    out = BucketedDimension(spark, str(path), dim.schema, ["k"], ["v", "w"], "tk", buckets)
    out.create("first", dim)
    return out


def files(dim):
    return {b: sorted(f for f in os.listdir(f"{dim.path}/data/_sw_attempt={a}/_sw_bucket={b}") if f.endswith(".parquet")) for b, a in dim.manifest().items()}


PAIRS = [(f"k{i}", i, None if i % 3 else "x") for i in range(60)]


def test_same_rows_as_the_plain_merge_and_untouched_files_stay(spark, tmp_path):
    dim, want = start(spark, tmp_path / "d", PAIRS), plain(spark, PAIRS)
    assert rows(dim.table()) == rows(want)
    loads = [
        [("k3", 99, "x"), ("k5", 5, None), ("new", 1, None)],
        [("k3", 99, "x"), ("k3x", 1, None), ("k9", 9, "y"), ("a", 0, None)],
        [(None, 1, "null key")],
        [(None, 1, "null key"), *PAIRS[20:24]],
    ]
    for i, load in enumerate(loads):
        inc, ts, before = spark.createDataFrame(load, "k string, v int, w string"), f"2024-0{i + 1}-01 00:00:00", files(dim)
        want = spark.createDataFrame(history.scd2_merge(want, inc, ["k"], ["v", "w"], "tk", ts).collect(), want.schema)
        touched = dim.merge(f"load {i}", inc, ts)
        assert rows(dim.table()) == rows(want)
        after = files(dim)
        assert len(touched) <= 3 and {b: f for b, f in after.items() if b not in touched} == {b: f for b, f in before.items() if b not in touched}
        assert all(after[b] != before.get(b) for b in touched)
        assert dim.merge(f"load {i}", inc, ts) == [] and files(dim) == after  # the same load again
    assert dim.log.entries()[-1]["written"] == []  # nothing had changed


def test_two_writers(spark, tmp_path):
    dims = [start(spark, tmp_path / "d", PAIRS) for _ in range(2)]
    incs = [spark.createDataFrame([(f"k{i}", 100 + n, "z") for i in range(n, n + 4)] + [(f"new{n}", n, None)], "k string, v int, w string") for n in (0, 2)]
    threads = [threading.Thread(target=d.merge, args=(str(i), x, "2024-01-01 00:00:00")) for i, (d, x) in enumerate(zip(dims, incs))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = rows(dims[0].table())
    tks = [r[0] for r in got]
    assert len(tks) == len(set(tks)) == 61 + 8 + 2 and max(tks) == 70
    assert len({(r[4], r[1]) for r in got}) == len(got)  # a version once


def test_the_number_of_buckets_is_fixed(spark, tmp_path):
    start(spark, tmp_path / "d", PAIRS)
    with pytest.raises(ValueError, match="16 buckets"):
        start(spark, tmp_path / "d", PAIRS, buckets=8).table()


def test_an_empty_dimension(spark, tmp_path):
    dim = start(spark, tmp_path / "d", [])
    empty = BucketedDimension(spark, str(tmp_path / "e"), dim.schema, ["k"], ["v", "w"], "tk")
    assert empty.table().count() == 0
    empty.merge("1", spark.createDataFrame([("a", 1, None)], "k string, v int, w string"), "2024-01-01 00:00:00")
    assert [r[0] for r in rows(empty.table())] == [1]


def test_a_repeated_key_is_refused(spark, tmp_path):
    dim = start(spark, tmp_path / "d", PAIRS)
    with pytest.raises(ValueError, match="repeat a natural key"):
        dim.merge("1", spark.createDataFrame([("k1", 5, None), ("k1", 6, None)], "k string, v int, w string"), "2024-01-01 00:00:00")
    assert len(dim.log.entries()) == 1
