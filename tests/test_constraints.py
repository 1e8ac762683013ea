import random

from conftest import rows
from pyspark.sql import types as T

from starweave.operators import constraints as C
from starweave.sources.files import materialize


def test_conform_try_casts_and_orders(spark):
    df = spark.createDataFrame([("unknown", "x"), ("7", "y")], "n string, s string")
    contract = T.StructType([T.StructField("s", T.StringType()), T.StructField("n", T.IntegerType()),
                             T.StructField("extra", T.DateType())])
    out = C.conform(df, contract)
    assert out.columns == ["s", "n", "extra"]
    assert rows(out) == [("x", None, None), ("y", 7, None)]


def test_checks(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None), (3, 1)], "id int, fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert rows(C.check_not_null(child, ["id", "fk"])) == [("fk", 1), ("id", 0)]
    assert rows(C.check_unique(child, ["id"])) == [(3, 2)]
    assert rows(C.check_fk(child, ["fk"], parent, ["pk"])) == [(2, 9)]


def judge(rows_, parents):
    """Plain Python: (row, reasons) for rows (id, k, s, p); id unique and not null, (k, s) unique, p in parents."""
    order = sorted(range(len(rows_)), key=lambda i: ([(x is None, x if x is not None else 0) for x in (rows_[i][3], rows_[i][0])], (rows_[i][1] is None, rows_[i][1] or 0), (rows_[i][2] is None, rows_[i][2] or "")))
    seen, out = {"id": set(), "k,s": set()}, [[] for _ in rows_]
    for i in order:
        a, k, s, p = rows_[i]
        out[i] += ["null:id"] if a is None else []
        out[i] += ["null:s"] if s is None else []
        for name, key in (("id", (a,)), ("k,s", (k, s))):
            if None not in key:
                out[i] += [f"duplicate:{name}"] if key in seen[name] else []
                seen[name].add(key)
        out[i] += ["orphan:p"] if p is not None and p not in parents else []
    return sorted(((*r, tuple(sorted(x))) for r, x in zip(rows_, out)), key=str)


def test_quarantine_splits_all_rows(spark):
    rnd = random.Random(6)
    data = [(rnd.choice([None, *range(150)]), rnd.choice([None, *range(30)]), rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *range(8)])) for _ in range(400)]
    data += [(1, 1, "a", 1)] * 60  # a hot key, rows all alike
    df = spark.createDataFrame(data, "id int, k int, s string, p int")
    parents = spark.createDataFrame([(i,) for i in range(5)], "q int")
    want = judge(data, set(range(5)))
    for limit in ("", "0"):
        if limit:
            spark.conf.set("spark.starweave.broadcastBytes", limit)
        try:
            good, bad = C.quarantine(df, ["id", "s"], [["id"], ["k", "s"]], [(["p"], parents, ["q"])], order=["p", "id"])
            assert good.columns == df.columns and bad.columns == [*df.columns, "reject_reasons"]
            got = [(*tuple(r)[:4], tuple(sorted(r.reject_reasons))) for r in bad.collect()] + [(*tuple(r), ()) for r in good.collect()]
            assert sorted(got, key=str) == want
        finally:
            spark.conf.unset("spark.starweave.broadcastBytes")


def test_quarantine_without_contracts_or_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "id int, s string")
    good, bad = C.quarantine(df)
    assert good.count() == 2 and bad.count() == 0
    good, bad = C.quarantine(df.limit(0), ["s"], [["id"]], [(["id"], df, ["id"])])
    assert good.count() == bad.count() == 0


def test_fk_check_of_a_counted_child_prunes_the_parent(spark):
    spark.conf.set("spark.starweave.broadcastBytes", "0")
    try:
        child = materialize(spark.createDataFrame([(1,), (None,), (7,), (9_999_999,)], "p long"), "child")
        parent = spark.range(100_000).withColumnRenamed("id", "q")
        out = C.check_fk(child, ["p"], parent, ["q"])
        assert rows(out) == [(9_999_999,)] and "NestedLoop" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.starweave.broadcastBytes")
