from llm import brute
import pytest
from pyspark.sql import functions as F

from starweave.llm import decontaminate as D
from starweave.llm.common import table

SF = "/root/testdata/sf0.001"


def both(docs, items, spark):
    return sorted(tuple(r) for r in D.query(docs, items).collect()), sorted(brute.contamination([r.asDict() for r in docs.collect()], [r.asDict() for r in items.collect()]))


def test_whole_tables_equal_brute_force(spark):
    got, want = both(table(spark, SF, "documents"), table(spark, SF, "benchmark"), spark)
    assert got == want and any(r[5] for r in got)


@pytest.fixture
def items(spark):
    long = " ".join(f"Word{i}" for i in range(14))
    rows = [(1, long), (2, "Two words"), (3, None), (4, ""), (5, "!!"), (6, "two WORDS"), (None, "lonely"), (7, "é É a1")]
    return spark.createDataFrame(rows, "item_id long, text string")


def edge_docs(make_docs):
    long = " ".join(f"word{i}" for i in range(14))
    rows = [
        (1, None), (2, ""), (3, "..!"), (4, long), (5, "x " + " ".join(f"word{i}" for i in range(3, 13)) + " y"),
        (6, " ".join(f"word{i}" for i in range(9))), (7, "one,two.words  two words two words"), (7, "one,two.words  two words two words"),
        (8, "Lonely é É a1 é é a1"), (None, "two words"), (9, ("filler " * 20000) + long + (" two words" * 500)), (10, "twowords two\x00words"),
    ]
    return make_docs(rows)


def test_edges(spark, make_docs, items):
    docs = edge_docs(make_docs)
    key = lambda r: tuple(str(x) for x in r)
    got = sorted((tuple(r) for r in D.query(docs, items).collect()), key=key)
    want = brute.contamination([r.asDict() for r in docs.collect()], [r.asDict() for r in items.where("item_id is not null").collect()])
    lonely = next(i for i, r in enumerate(want) if r[0] == 8)
    want[lonely] = (8, want[lonely][1], want[lonely][2] + 1, *want[lonely][3:])  # an item without an id marks words only
    assert got == sorted(want, key=key)


def test_shuffle_join_beyond_the_broadcast_size(spark, make_docs, items, monkeypatch):
    docs = edge_docs(make_docs)
    want = sorted(map(str, D.query(docs, items).collect()))
    monkeypatch.setattr(D, "BROADCAST_BYTES", -1)
    assert sorted(map(str, D.query(docs, items).collect())) == want


def test_few_windows_reach_the_join_by_chance(spark, make_docs):
    """A benchmark whose windows fill much of the small table: the filter behind it keeps chance away from the join."""
    many = spark.range(2_500).select(F.col("id").alias("item_id"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("b"), F.pmod(F.xxhash64("id", i), F.lit(5_000)).cast("string"))), " ").alias("text"))
    n = D.benchmark_windows(many).count()
    assert n > 200_000 and D.table_slots(n) == D.MAX_SLOTS
    grams = D.benchmark_windows(many)
    bits = D.size_for(n)
    held = D.bloom_filter(grams, ["gram"], bits).scalar()
    other = spark.range(200_000).select(F.concat(F.lit("x "), F.col("id").cast("string")).alias("gram"))
    assert other.where(D.may_hold(held, [F.col("gram")], bits)).count() < 2_000
    assert grams.where(D.may_hold(held, [F.col("gram")], bits)).count() == n
    text = many.where("item_id = 7").first().text
    got = {r.doc_id: (r.n_hit, r.n_items) for r in D.query(make_docs([(1, text), (2, "no such words " * 50), (3, None)]), many).collect()}
    assert got == {1: (100, 1), 2: (0, 0), 3: (0, 0)}


def test_empty_tables(spark, make_docs, items):
    assert D.query(make_docs([]), items).collect() == []
    got = D.query(make_docs([(1, "two words")]), items.limit(0)).first()
    assert (got.n_words, got.n_hit, got.contaminated) == (2, 0, False)


def test_extra_columns_with_clashing_names(spark, make_docs, items):
    docs = make_docs([(1, "two words")]).selectExpr("*", "1 AS w", "2 AS span", "3 AS hash", "4 AS row")
    assert D.query(docs, items.selectExpr("*", "1 AS gram", "2 AS len")).first().n_hit == 2


def test_stage_drops_hits_only_and_keeps_columns(spark):
    docs = table(spark, SF, "documents")
    kept = D.drop_contaminated(spark, docs, SF)
    bad = {r[0] for r in brute.contamination([r.asDict() for r in docs.collect()], [r.asDict() for r in table(spark, SF, "benchmark").collect()]) if r[5]}
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad


def test_words_inside_spans_can_be_cut_out(spark):
    df = spark.createDataFrame([(" A b, c  d", [(1, 2)]), ("A b, c  d", [(0, 1), (3, 1)]), ("a b", [])], "text string, spans array<struct<at:int,len:int>>")
    assert [r[0] for r in df.select(D.without_spans(df.text, df.spans)).collect()] == [" A d", "b, c  ", "a b"]


def test_main_path_holds_no_python(spark):
    plan = D.query(table(spark, SF, "documents"), table(spark, SF, "benchmark"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_spans_can_go_instead_of_documents(spark, make_docs, items):
    docs = make_docs([(1, "Keep this, two words! And that"), (2, "clean text"), (None, None), (3, " ".join(f"word{i}" for i in range(14)) + " tail")]).selectExpr("*", "7 AS hit_spans")
    out = D.remove_spans(docs, items)
    assert out.columns == docs.columns
    assert {r.doc_id: (r.text, r.hit_spans) for r in out.collect()} == {1: ("Keep this, And that", 7), 2: ("clean text", 7), None: (None, 7), 3: ("tail", 7)}
