from conftest import rows
from pyspark.sql import functions as F

from starweave.operators import joins
from starweave.plans import normalize as N


def _fact(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d"), (9, "e")], "k int, x string")


def _dim(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, tk int")


def test_lookup_join_broadcast_and_shuffle_agree(spark):
    f, d = _fact(spark), _dim(spark)
    bc = joins.lookup_join(f, d, [(F.col("k"), "k")], broadcast=True)
    sh = joins.lookup_join(f, d, [(F.col("k"), "k")], broadcast=False)
    assert rows(bc) == rows(sh) == [(1, "a", 10), (2, "b", 20), (9, "e", None), (None, "c", None), (None, "d", None)]
    assert "BroadcastHashJoin" in bc._jdf.queryExecution().executedPlan().toString()
    assert not joins.fits_broadcast(d)  # not measured: no broadcast is forced
    assert "_sw_fsalt" in sh._jdf.queryExecution().optimizedPlan().toString()


def test_left_join_keeps_every_row(spark):
    f = spark.range(0, 500).select((F.col("id") % 7).alias("k"))
    d = spark.createDataFrame([(1, 1), (2, 2)], "k long, tk int")
    assert joins.lookup_join(f, d, [(F.col("k"), "k")]).count() == 500


def test_first_match_lookup_smallest_id(spark):
    table = spark.createDataFrame([(5, "Flood"), (2, "Flood"), (7, "Fire")], "id int, t string")
    df = spark.createDataFrame([("Flood",), ("Storm",)], "v string")
    assert rows(joins.first_match_lookup(df, "v", table, "t", "id", "fk")) == [("Flood", 2), ("Storm", None)]


def test_insert_if_absent_idempotent(spark):
    incoming = spark.createDataFrame([("x", "A"), ("y", "B"), ("y", "B"), ("z", None)], "name string, k string")
    first = N.append_entities(None, incoming, ["k"])
    second = N.append_entities(first, incoming, ["k"])
    assert rows(first) == rows(second)
    assert sorted(r.id for r in first.collect()) == [1, 2, 3]


def test_bridge_keeps_pairs_with_both_ids(spark):
    pairs = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B"), (3, "A")], "dn int, cn string")
    dis = spark.createDataFrame([(1, 1), (2, 2)], "id int, dn int")
    st = spark.createDataFrame([(1, "A")], "id int, cn string")
    out = N.bridge(pairs, dis, "dn", st, "cn")
    assert rows(out) == [(1, 1, 1)]


def test_null_safe_anti(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    ex = spark.createDataFrame([(None,), ("a",)], "k string")
    assert rows(joins.null_safe_anti(df, ex, ["k"])) == [("b",)]


def test_shuffle_join_salts_hot_key(spark):
    # one key holds a third of the fact rows; the dimension is forced to the shuffle path
    hot = spark.range(0, 30000).select(F.lit(7).alias("k"), F.col("id").alias("rid"))
    cold = spark.range(0, 60000).select((F.col("id") % 5000 + 100).alias("k"), F.col("id").alias("rid"))
    fact = hot.unionByName(cold)
    dim = spark.range(0, 6000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("tk"))
    hot = joins.hot_keys(fact, {"a": ["k"], "b": [F.col("rid")]}, fraction=0.05)
    assert hot["a"] == ['{"k0":7}'] and hot["b"] == []
    salted = joins.lookup_join(fact, dim, [(F.col("k"), "k")], broadcast=False, hot=hot["a"])
    plain = joins.lookup_join(fact, dim, [(F.col("k"), "k")], broadcast=True)
    assert salted.count() == 90000
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_identical_rows_of_a_hot_key_get_different_salts(spark):
    fact = spark.range(0, 5000, 1, 4).select(F.lit(7).alias("k"))
    dim = spark.createDataFrame([(7, 70)], "k int, tk int")
    out = joins.lookup_join(fact, dim, [(F.col("k"), "k")], broadcast=False, hot=['{"k0":7}'])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in plan
    assert out.where("tk = 70").count() == 5000


def test_check_fk_shuffle_path_equals_broadcast(spark, monkeypatch):
    from starweave.operators import constraints

    child = spark.createDataFrame([(i % 5 if i % 7 else None, i) for i in range(200)], "fk int, i int")
    parent = spark.createDataFrame([(0,), (1,), (1,), (2,)], "pk int")
    want = [(r.fk, r.i) for r in child.collect() if r.fk in (3, 4)]
    assert rows(constraints.check_fk(child, ["fk"], parent, ["pk"])) == sorted(want)
    assert rows(constraints.check_fk(child, ["fk"], parent, ["pk"], hot=['{"k0":3}', '{"k0":1}'])) == sorted(want)


def test_distinct_rows_that_lie_by_key_are_not_moved_for_its_lookup(spark):
    data = [(None if i % 4 == 0 else 7 if i % 3 else i % 50, f"x{i % 60}") for i in range(3000)] + [(7, "x")] * 500 + [(None, None)] * 500
    fact = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "k int, x string, n int")
    dim = spark.createDataFrame([(i, 10 * i) for i in range(0, 40)], "k int, tk int")
    for hot in ([], ['{"k0":7}']):
        near = joins.distinct_by_key(fact, ["k", "x"], "k", hot, "s")
        assert sorted(map(str, near.drop("s").collect())) == sorted(map(str, fact.select("k", "x").distinct().collect()))
        for how in ("left", "inner"):
            out = joins.lookup_join(near, dim, [(F.col("k"), "k")], how, broadcast=False, hot=hot, salt="s")
            want = joins.lookup_join(fact.select("k", "x").distinct(), dim, [(F.col("k"), "k")], how, broadcast=True)
            assert sorted(map(str, out.drop("s").collect())) == sorted(map(str, want.collect()))
            out = joins.lookup_join(near, dim.hint("merge"), [(F.col("k"), "k")], how, broadcast=False, hot=hot, salt="s")
            moved = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x and "ENSURE" in x and "_sw_k0" in x]
            assert not moved
    hot_rows = fact.where("k = 7").select("k", "x").distinct().count()
    assert near.where("k = 7").select("s").distinct().count() > min(hot_rows, joins.HOT_KEY_SALTS) // 3
    assert near.where("k is null").select("s").distinct().count() > 3
