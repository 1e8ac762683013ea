"""Loads that die, come again, or race: each counts once, and no two rows share an id."""

import json
import os
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starweave.operators.registry import KeyRegistry
from starweave.plans.dimensions import DimensionSpec, build_dimension
from starweave.plans.normalize import absent_rows, insert_if_absent_logged
from starweave.sources.commit_log import CommitLog


@pytest.fixture
def log(spark, tmp_path):
    return CommitLog(spark, str(tmp_path / "t"), "k string, v int", id_col="id", order=["k"])


def df(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v int")


def test_loads_are_numbered_behind_each_other(spark, log):
    assert log.table().columns == ["id", "k", "v"] and log.table().count() == log.count() == 0
    log.append("1", df(spark, ("b", 1), ("a", 2)))
    log.append("2", df(spark, ("a", 3)))
    log.append("3", df(spark).limit(0))
    log.append("4", df(spark, ("z", 4), (None, 5)))
    assert rows(log.table()) == [(1, "a", 2), (2, "b", 1), (3, "a", 3), (4, None, 5), (5, "z", 4)]
    assert rows(log.table(["2"])) == [(3, "a", 3)] and log.count() == 5 and log.orphans() == []
    assert [c.number for c in log.commits()] == [0, 1, 2, 3]


def test_a_load_that_comes_again_adds_nothing(spark, log):
    first = log.append("x", df(spark, ("a", 1)))
    assert log.append("x", df(spark, ("a", 1))) == first == CommitLog(spark, log.path, log.schema, "id", ["k"]).append("x", df(spark, ("other", 9)))
    assert rows(log.table()) == [(1, "a", 1)] and log.orphans() == []


def test_a_lost_driver_leaves_nothing_behind(spark, log):
    log.append("1", df(spark, ("a", 1)))
    log.write_attempt(df(spark, ("b", 2)))  # and there it died
    assert rows(log.table()) == [(1, "a", 1)] and len(log.orphans()) == 1
    log.append("2", df(spark, ("b", 2)))  # the next try
    assert rows(log.table()) == [(1, "a", 1), (2, "b", 2)] and len(log.orphans()) == 1


def test_a_task_that_fails_leaves_nothing_behind(spark, log):
    bad = df(spark, ("a", 1), ("b", 0)).withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("no"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="no"):
        log.append("1", bad)
    assert log.table().count() == 0 and log.commits() == []


def test_an_unfinished_entry_is_not_read(spark, log):
    log.append("1", df(spark, ("a", 1)))
    with open(f"{log.path}/log/_half", "w") as f:
        f.write('{"number"')
    assert rows(CommitLog(spark, log.path, log.schema, "id", ["k"]).table()) == [(1, "a", 1)]


def test_two_writers_share_no_ids(spark, tmp_path):
    logs = [CommitLog(spark, str(tmp_path / "t"), "k string, v int", "id", ["k"]) for _ in range(4)]
    barrier, errors = threading.Barrier(4), []

    def work(i):
        try:
            attempt = logs[i].write_attempt(spark.range(7).select(F.concat(F.lit(f"{i}-"), F.col("id").cast("string")).alias("k"), F.lit(i).alias("v")))
            barrier.wait()
            logs[i].commit(f"load {i}", *attempt)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = rows(logs[0].table())
    assert [r[0] for r in got] == list(range(1, 29)) and len({r[1] for r in got}) == 28
    names = sorted(n for n in os.listdir(tmp_path / "t" / "log") if n.endswith(".json"))
    assert [json.load(open(tmp_path / "t" / "log" / n))["number"] for n in names] == [0, 1, 2, 3]


def test_two_writers_of_one_load_commit_one(spark, log):
    other = CommitLog(spark, log.path, log.schema, "id", ["k"])
    a, b = log.write_attempt(df(spark, ("a", 1))), other.write_attempt(df(spark, ("a", 1)))
    assert log.commit("x", *a) == other.commit("x", *b) and log.count() == 1 and len(log.orphans()) == 1


def test_a_keyed_append_sees_what_another_writer_committed(spark, log):
    other, tries = CommitLog(spark, log.path, log.schema, "id", ["k"]), []
    log.append("1", df(spark, ("a", 1)))
    incoming = df(spark, ("a", 9), ("b", 9), ("c", 9), ("c", 8), (None, 7), (None, 6))

    def build(table):
        tries.append(1)
        if len(tries) == 1:  # while the rows are computed, another writer comes first
            other.append("2", df(spark, ("b", 5), (None, 0)))
        return absent_rows(incoming, table, ["k"])

    log.append_from("3", build)
    assert len(tries) == 2 and [r[1] for r in rows(log.table())] == ["a", None, "b", "c"]
    insert_if_absent_logged(log, "4", incoming, ["k"])
    assert log.count() == 4 and rows(log.table())[-1] == (4, "c", 8)


def test_a_log_without_ids(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), "k string, v int")
    log.append("1", df(spark, ("a", 1)))
    log.append("1", df(spark, ("a", 1)))
    assert rows(log.table()) == [("a", 1)]
    with pytest.raises(ValueError):
        CommitLog(spark, str(tmp_path / "u"), "k string", id_col="id")
    with pytest.raises(ValueError):
        CommitLog(spark, str(tmp_path / "u"), "id long", id_col="id", order=["id"])


SPEC = DimensionSpec("d", "tk", ("k",), ("v",), unknown={"k": "UNKNOWN"})


def test_keys_outlive_a_refresh(spark, tmp_path):
    reg = KeyRegistry(spark, str(tmp_path / "r"), "k string", "tk")
    first = build_dimension([df(spark, ("m", 1), ("x", 2), (None, 3))], SPEC, "2024-01-01 00:00:00", registry=reg, load_id="1")
    assert [(r[0], r[4], r[5]) for r in rows(first)] == [(0, "UNKNOWN", None), (1, "m", 1), (2, "x", 2)]
    again = KeyRegistry(spark, str(tmp_path / "r"), "k string", "tk")
    second = build_dimension([df(spark, ("a", 5), ("x", 6), ("q", 7))], SPEC, "2024-02-01 00:00:00", registry=again, load_id="2")
    assert [(r[0], r[4], r[5]) for r in rows(second)] == [(0, "UNKNOWN", None), (2, "x", 6), (3, "a", 5), (4, "q", 7)]
    build_dimension([df(spark, ("a", 5), ("x", 6), ("q", 7))], SPEC, "2024-02-01 00:00:00", registry=again, load_id="2")
    assert rows(reg.table()) == [(1, "m"), (2, "x"), (3, "a"), (4, "q")]
    with pytest.raises(ValueError):
        build_dimension([df(spark, ("a", 5))], SPEC, "2024-02-01 00:00:00", registry=again)


def test_the_first_refresh_equals_plain_numbering(spark, tmp_path):
    src = spark.range(200).select(F.concat(F.lit("k"), (F.col("id") % 90).cast("string")).alias("k"), F.col("id").cast("int").alias("v"))
    reg = KeyRegistry(spark, str(tmp_path / "r"), "k string", "tk")
    a = build_dimension([src], SPEC, "2024-01-01 00:00:00", registry=reg, load_id="1")
    assert rows(a) == rows(build_dimension([src], SPEC, "2024-01-01 00:00:00"))


def test_two_keys_and_two_writers(spark, tmp_path):
    regs = [KeyRegistry(spark, str(tmp_path / "r"), "a int, b string", "tk") for _ in range(2)]
    members = [spark.createDataFrame([(1, "x"), (2, "x"), (None, "x")], "a int, b string"), spark.createDataFrame([(2, "x"), (2, "y")], "a int, b string")]
    threads = [threading.Thread(target=r.extend, args=(str(i), m)) for i, (r, m) in enumerate(zip(regs, members))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = rows(regs[0].table())
    assert [r[0] for r in got] == [1, 2, 3] and {r[1:] for r in got} == {(1, "x"), (2, "x"), (2, "y")}
