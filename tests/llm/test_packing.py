import itertools
import random
from collections import defaultdict

import pytest

from starweave.llm import packing as P
from starweave.llm.common import table

SF = "/root/testdata/sf0.001"


def padding(bins, ends):
    return sum(next(e for e in ends if e >= top) * n - total for top, n, total in bins)


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    rnd = random.Random(seed)
    tops = sorted(rnd.sample(range(1, 60), 9))
    bins = [(t, n := rnd.randint(1, 9), t * n) for t in tops]
    for k in (1, 2, 3, 4, 9, 12):
        ends = P.boundaries(bins, k)
        assert len(ends) <= k and ends[-1] == tops[-1]
        best = min(padding(bins, [*c, tops[-1]]) for c in itertools.combinations(tops[:-1], min(k, 9) - 1))
        assert padding(bins, ends) == best


def check(rows, counts, budget):
    assert sorted(r.n_tokens for r in rows) == sorted(counts)
    batches = defaultdict(list)
    for r in rows:
        assert 0 <= r.padding == r.bucket_len - r.n_tokens
        batches[r.bucket, r.shard, r.batch].append(r)
    for b in batches.values():
        assert len(b) == 1 or len(b) * b[0].bucket_len <= budget or b[0].bucket_len == 0
        assert sorted(r.slot for r in b) == list(range(len(b)))
    per_shard = defaultdict(list)
    for (bucket, shard, _), b in batches.items():
        per_shard[bucket, shard].append(len(b))
    for sizes in per_shard.values():  # all batches but one per shard are full
        assert sum(n < max(sizes) for n in sizes) <= 1
    ends = {r.bucket: r.bucket_len for r in rows}
    for r in rows:
        assert r.bucket == 0 or r.n_tokens > ends[r.bucket - 1]


def test_whole_table(spark, rows_of):
    rows = P.query(table(spark, SF, "documents")).collect()
    docs = rows_of("documents")
    assert sorted(r.doc_id for r in rows) == sorted(d["doc_id"] for d in docs)
    check(rows, [len((d["text"] or "").encode().split()) for d in docs], P.BUDGET)


def test_shards_and_small_budget(spark, rows_of, monkeypatch):
    monkeypatch.setattr(P, "SHARD_ROWS", 20)
    rows = P.pack(table(spark, SF, "documents"), buckets=3, budget=500).collect()
    assert len({r.shard for r in rows}) > 1
    check(rows, [len((d["text"] or "").encode().split()) for d in rows_of("documents")], 500)


def test_edges(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "a"), (3, "a"), (None, "a b"), (4, "x " * 200000), (5, "a b c")]).selectExpr("*", "1 AS row", "2 AS bucket", "3 AS n_tokens")
    check(P.query(docs).collect(), [0, 0, 1, 1, 2, 200000, 2], P.BUDGET)
    assert P.query(make_docs([])).collect() == []
