from llm import brute
import corpus_pipeline
import pytest

from starweave.llm import language_id, secrets
from starweave.llm.common import table

SF = "/root/testdata/sf0.01"


def test_stages_equal_brute_force(spark, rows_of):
    docs = table(spark, SF, "documents")
    items = rows_of("benchmark", SF)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_dedup", "decontamination", "secrets", "packing"]
    rows = {d["doc_id"]: d["text"] for d in rows_of("documents", SF)}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == table(spark, SF, "documents").columns
            out = spark.createDataFrame(out.collect(), out.schema)
        got = {r.doc_id: r for r in out.collect()}
        if name == "language_id":
            want = {i for i, t in rows.items() if t and any(c.isalpha() for c in t)}
            assert set(got) <= want and len(got) > 0.99 * len(want)
        elif name == "simhash_dedup":
            codes = {i: brute.simhash(t) for i, t in rows.items()}
            assert set(got) == set(brute.components(codes).values())
        elif name == "decontamination":
            found = brute.contamination([{"doc_id": i, "text": t} for i, t in rows.items()], items)
            assert set(got) == {r[0] for r in found if not r[5]}
        elif name == "secrets":
            assert set(got) == set(rows)
            for i, r in got.items():
                assert r.n_chars == len(r.text) and not brute.base_secrets(r.text)
                assert (secrets.MASK in r.text) or r.text == rows[i] or secrets.candidates(rows[i])
        else:
            assert {i: r.n_tokens for i, r in got.items()} == {i: len(t.encode().split()) for i, t in rows.items()}
        if name != "packing":
            docs, rows = out, {i: r.text for i, r in got.items()}


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "bucket", "batch", "slot"} <= set(out.columns) and out.count() > 0


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, None)], [(1, "12"), (1, "12")]])
def test_nothing_left(spark, make_docs, rows):
    docs = make_docs(rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.collect() == []
    assert language_id.MIN_SCORE < 0.5


EXTRA = ["code", "component", "node", "gone", "gone_id", "gone_key", "key", "row", "spans", "span", "w", "hash", "gram", "lang_pred", "score",
         "cut", "cut_id", "text_key", "id", "owner", "n_tokens", "bucket", "shard", "at", "n", "rank"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_with_clashing_columns_nulls_and_repeats(spark, make_docs, name, stage):
    good = "the and of that with some words here"
    rows = [(i, f"{good} number {i} " + "abc "[: i % 4] * i, "en") for i in range(30)] + [(40, "x " * 100000, "en"), (None, f"{good} no id", None, None)]
    docs = make_docs(rows + [rows[3]]).selectExpr("*", *[f"{i} AS {c}" for i, c in enumerate(EXTRA)])
    out = stage(spark, docs, "/root/testdata/sf0.001")
    got = out.collect()
    if name == "packing":
        assert len(got) == len(rows) + 1 and "batch" in out.columns
        return
    assert out.columns == docs.columns
    assert {r.doc_id for r in got} <= {r[0] for r in rows} and sum(r.doc_id == 3 for r in got) in (0, 2)
    assert all(r[c] == i for r in got for i, c in enumerate(EXTRA))
    if name in ("decontamination", "secrets"):
        assert len(got) == len(rows) + 1
