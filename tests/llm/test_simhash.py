from llm import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.llm import simhash as S
from starweave.llm.common import connected, table

SF = "/root/testdata/sf0.001"


def want_rows(docs):
    codes = {d["doc_id"]: brute.simhash(d["text"]) for d in docs}
    comp = brute.components(codes)
    return sorted((i, f"{codes[i]:016x}", comp[i]) for i in codes)


def test_whole_table_equals_brute_force(spark, rows_of):
    got = sorted(tuple(r) for r in S.query(table(spark, SF, "documents")).collect())
    assert got == want_rows(rows_of("documents"))
    assert len({r[2] for r in got}) < len(got)


def test_edges(spark, make_docs):
    rows = [(5, None), (4, ""), (9, " \t"), (1, "one"), (2, "one two"), (3, "ONE\x0bTwo"), (6, "é É"), (7, "a b c"), (8, "a b c a b c"), (10, "w " * 200000), (11, "w " * 3), (12, "a b c d")]
    docs = make_docs(rows).selectExpr("*", "1 AS code", "2 AS node", "3 AS component")
    got = sorted(tuple(r) for r in S.query(docs).collect())
    assert got == want_rows([{"doc_id": i, "text": t} for i, t in rows])


def test_null_ids_repeated_rows_and_empty_table(spark, make_docs):
    got = {(r.doc_id, r.component_id) for r in S.query(make_docs([(None, "x y z"), (3, "x y z"), (3, "x y z"), (None, "other words here now")])).collect()}
    assert got == {(None, 3), (3, 3), (None, None)}


def test_rows_without_an_id_link_others(spark):
    codes = lambda rows: spark.createDataFrame(rows, "doc_id long, code long")
    assert {r.component for r in S.components(codes([(1, 0), (None, 7), (2, 63)])).collect()} == {1}
    rng = np.random.default_rng(11)
    for _ in range(3):
        rows = [(None if rng.random() < 0.5 else int(rng.integers(0, 60)), int(sum(1 << int(b) for b in rng.integers(0, 14, rng.integers(0, 9))))) for _ in range(60)]
        by_code = {c: i for i, c in enumerate(sorted({c for _, c in rows}))}
        groups = brute.components({i: c for c, i in by_code.items()})
        ids = {}
        for i, c in rows:
            ids.setdefault(groups[by_code[c]], set()).add(i)
        want = {c: min((i for i in ids[groups[n]] if i is not None), default=None) for c, n in by_code.items()}
        assert {r.code: r.component for r in S.components(codes(rows)).collect()} == want


def test_the_table_without_rows(spark, make_docs):
    assert S.query(make_docs([])).collect() == []


@pytest.mark.parametrize("block,fan,parts", [(4096, 8, None), (16, 3, 4), (7, 2, 4), (16, 4, 5), (9, 8, 6)])
def test_index_finds_all_links_of_random_and_clustered_codes(spark, monkeypatch, block, fan, parts):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "FAN", fan)
    rng = np.random.default_rng(block)
    codes = list(rng.integers(0, 2**64, 60, dtype=np.uint64))
    for c in codes[:12]:  # chains and clusters around some codes
        x = int(c)
        for _ in range(12):
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(b)
            codes.append(np.uint64(x))
    codes = sorted(set(map(int, codes)))
    rng.shuffle(codes)
    points = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c, i) for i, c in enumerate(codes)], "code long, node long")
    groups = {r.node: r.component for r in connected(S.near_pairs(points, parts=parts), "t").collect()}
    want = brute.components({i: c for i, c in enumerate(codes)})
    assert {i: groups.get(i, i) for i in want} == want


def test_search_prunes_but_finds_every_near_code():
    rng = np.random.default_rng(3)
    top = np.uint64(7 << 48)
    codes = np.unique(rng.integers(0, 2**10, 300, dtype=np.uint64) | top)
    q, leaf = S.search(codes, S.build(codes), S.top_mask(16))
    want = {(i, j) for i in range(len(codes)) for j in range(len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= 3}
    assert set(zip(q.tolist(), leaf.tolist())) == want


def test_more_bits_than_the_chunks_can_find_are_refused(spark):
    with pytest.raises(ValueError):
        S.near_pairs(spark.createDataFrame([(1, 1)], "code long, node long"), 4)


def test_stage_keeps_the_smallest_id_of_each_group(spark, rows_of):
    docs = table(spark, SF, "documents")
    kept = S.keep_one(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want_rows(rows_of("documents"))})


def test_stage_drops_texts_not_ids(spark, make_docs):
    a, b, c = "one two three four five", "six seven eight nine ten", "some other words are here"
    rows = [(5, a), (5, a), (5, b), (2, b), (2, b), (7, a), (None, b)]
    assert sorted((r.doc_id or 0, r.text) for r in S.keep_one(spark, make_docs(rows), SF).collect()) == [(0, b), (2, b), (2, b), (5, a), (5, a)]
    # 5 is the least id of two texts, one of which is near a text of 2
    long = " ".join(f"w{i}" for i in range(400))
    near = long + "".join(f" x{i}" for i in range(8))
    assert (int(S.fingerprint(near)) ^ int(S.fingerprint(long))).bit_count() == S.MAX_BITS
    rows = [(5, long), (5, c), (6, c), (2, near), (9, long), (None, a)]
    assert sorted((r.doc_id or 0, r.text) for r in S.keep_one(spark, make_docs(rows), SF).collect()) == [(0, a), (2, near), (5, c)]
    got = {(r.doc_id, r.component_id) for r in S.query(make_docs(rows)).collect()}
    assert got == {(5, 5), (5, 2), (6, 5), (2, 2), (9, 2), (None, None)}


def test_layouts_bring_every_choice_of_parts_to_the_top(spark):
    for parts in (4, 5, 6):
        for layout in S.layouts(parts):
            assert sorted(i for old, _, n in layout for i in range(old, old + n)) == list(range(64))
            assert sorted(i for _, new, n in layout for i in range(new, new + n)) == list(range(64))
    code = 0x0123456789ABCDEF
    got = spark.range(1).select(*[S.arranged(F.lit(code).cast("long"), x) for x in S.layouts(4)]).first()
    assert [f"{c & (1 << 64) - 1:016x}"[:4] for c in got] == ["cdef", "89ab", "4567", "0123"]
