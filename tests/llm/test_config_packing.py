import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from starweave.llm import config_packing as C
from starweave.llm.common import BATCH_ROWS, table

SF = "/root/testdata/sf0.001"


def pieces_of(tok, doc_id, text, capacity=2048):
    ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
    for piece, at in enumerate(range(0, len(ids), capacity)):
        part = ids[at : at + capacity]
        yield doc_id, piece, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def check(rows, want, capacity=2048):
    """All pieces are there, and each sequence is filled without gap or overlap; returns the number of sequences."""
    assert sorted((tuple(r[:5]) for r in rows), key=str) == sorted(want, key=str)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_whole_table(spark, rows_of):
    tok = Tokenizer.from_file(C.tokenizer_path())
    rows = C.query(table(spark, SF, "documents")).collect()
    want = [p for d in rows_of("documents") for p in pieces_of(tok, d["doc_id"], d["text"])]
    assert check(rows, want) <= -(-sum(p[3] for p in want) // 2048) + 1


def test_edges(spark, make_docs):
    tok = Tokenizer.from_file(C.tokenizer_path())
    long = "so " * 2047  # with the end id exactly one full piece
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (4, "a"), (None, "b c"), (5, long), (6, long + "so"), (7, "word. " * 9_000), (8, "x" * 3_000)]
    docs = make_docs(rows).selectExpr("*", "1 AS row", "2 AS length", "3 AS sequence_id", "4 AS rank")
    want = [p for r in rows for p in pieces_of(tok, *r)]
    assert [p[3] for p in want if p[0] in (5, 6)] == [2048, 2048, 1]
    assert check(C.query(docs).collect(), want) == -(-sum(p[3] for p in want) // 2048)
    assert C.query(make_docs([])).collect() == []


def test_real_ids(spark, make_docs):
    tok = Tokenizer.from_file(C.tokenizer_path())
    rows = C.cut(make_docs([(1, "One two, three four. Five")]), C.tokenizer_path(), capacity=4, with_ids=True).collect()
    got = [i for r in sorted(rows, key=lambda r: r.piece) for i in struct.unpack(f"<{r.length}I", r.ids)]
    assert got == [*tok.encode("One two, three four. Five", add_special_tokens=False).ids, 0]


def test_texts_come_in_small_batches(spark, monkeypatch):
    class Sizes:
        def encode(self, batch):
            return [len(batch).to_bytes(4, "little")] * len(batch)

    monkeypatch.setattr(C, "encoder", lambda path: Sizes())
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    docs = spark.range(0, 5 * BATCH_ROWS, 1, 1).selectExpr("id AS doc_id", "'a' AS text")
    try:
        spark.conf.set(key, "10000")  # Spark's default, as in a session whose first query this is
        rows = C.cut(docs, "", with_ids=True).collect()
    finally:
        spark.conf.set(key, old)
    assert [struct.unpack("<2I", r.ids) for r in rows] == [(BATCH_ROWS, 0)] * (5 * BATCH_ROWS)


@pytest.mark.parametrize("remembered", [C.REMEMBERED, 5])
def test_encoder_gives_the_tokenizer_s_ids(remembered, monkeypatch):
    monkeypatch.setattr(C, "REMEMBERED", remembered)
    enc = C.Encoder(C.tokenizer_path())
    ids = lambda x: list(struct.unpack(f"<{len(x) // 4}I", x))
    texts = ["<|endoftext|> a", "Don't'S 'll we're <|ENDOFTEXT|>", "é Ésprit! ×÷ àßÿ. x.y. ...", "x\xa0y\x1cz", "日本語 1½²3.", "A" * 5000 + ". b", "İ ΣΑΣ.", None]
    rnd = random.Random(3)
    letters = "aBcÉß×.,'!? \n<|́İ9½s're"
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randrange(40))) for _ in range(800)]
    want = [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids(x) for x in enc.encode(texts)] == want == [ids(enc.encode([t])[0]) for t in texts]
    assert len(enc.known) < C.REMEMBERED + 12_000


def fewest(pieces, capacity):
    """The fewest sequences, by trying all ways."""
    best = [len(pieces)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= pieces[i]}.values():
            place(i + 1, [*rooms[:j], rooms[j] - pieces[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - pieces[i]])

    place(0, [])
    return best[0]


def holds(plan, histogram, capacity):
    got = Counter()
    for held, times in plan:
        assert times > 0 and sum(k * n for k, n in held.items()) <= capacity
        for k, n in held.items():
            got[k] += n * times
    assert got == Counter({k: n for k, n in histogram.items() if n})
    return sum(times for _, times in plan)


@pytest.mark.parametrize("seed", range(12))
def test_small_plans_against_all_ways(seed):
    rnd = random.Random(seed)
    pieces = sorted((rnd.randint(1, 20) for _ in range(9)), reverse=True)
    h = Counter(pieces)
    least = fewest(pieces, 20)
    assert least <= holds(C.plan(dict(h), 20), h, 20) <= least + 1
    open_h = {k: n for k, n in h.items() if k < 20}
    lengths = np.array(sorted(open_h))
    bound = C.solve(lengths, np.array([open_h[int(x)] for x in lengths], dtype=float), 20)[2]
    assert bound + h[20] <= least + 1e-9


def test_knapsack_against_all_ways():
    rnd = random.Random(5)
    for _ in range(20):
        lengths = np.array(sorted(rnd.sample(range(1, 13), 4)))
        prices = np.array([rnd.random() for _ in lengths])
        best, last = C.knapsack(lengths, prices, 24)
        for room in range(25):
            most = max(sum(prices[i] for i in c) for n in range(25) for c in ways(lengths, room, n))
            held = C._contents(last, lengths, room)
            assert best[room] == pytest.approx(most) == pytest.approx(sum(prices[i] * n for i, n in held.items()))
            assert sum(lengths[i] * n for i, n in held.items()) <= room


def ways(lengths, room, n):
    """Choices of n pieces (places, ascending) that fit."""
    if n == 0:
        yield ()
        return
    for c in ways(lengths, room, n - 1):
        for i in range(c[-1] if c else 0, len(lengths)):
            if sum(lengths[j] for j in c) + lengths[i] <= room:
                yield (*c, i)


def test_the_program_beats_best_fit_where_best_fit_is_poor():
    rnd = np.random.default_rng(1)
    h = {int(n): int(rnd.integers(1, 400)) for n in range(500, 1100)}
    greedy = C.best_fit(h, 2048)
    assert holds(C.plan(h), h, 2048) < 0.97 * holds(greedy, h, 2048)


def test_counts_of_any_size_take_the_same_work():
    h = {k: 10**9 * (1 + k % 7) for k in range(1, 2049, 9)}
    lengths = np.array(sorted(h))
    bound = C.solve(lengths, np.array([h[int(x)] for x in lengths], dtype=float), 2048)[2]
    plan = C.plan(h)
    assert bound <= holds(plan, h, 2048) <= 1.03 * bound and len(plan) < 20_000


def test_best_fit_equals_one_piece_at_a_time():
    rnd = random.Random(8)
    for _ in range(60):
        pieces = sorted((rnd.randint(1, 30) for _ in range(rnd.randrange(60))), reverse=True)
        rooms = []
        for p in pieces:
            fit = [r for r in rooms if r >= p]
            if fit:
                rooms.remove(min(fit))
            rooms.append((min(fit) if fit else 30) - p)
        assert holds(C.best_fit(dict(Counter(pieces)), 30), Counter(pieces), 30) == len(rooms)


def test_buckets_of_a_common_length(spark, monkeypatch, rows_of):
    monkeypatch.setattr(C, "BUCKET_ROWS", 7)
    pieces = spark.range(400).selectExpr("id AS row", "0L AS piece", "if(id % 3 = 0, id % 11 + 1, 5) AS length", "id AS n")
    rows = C.pack(pieces, capacity=16).collect()
    seen = defaultdict(set)
    for r in rows:
        spot = set(range(r.offset, r.offset + r.length))
        assert not spot & seen[r.sequence_id] and max(spot) < 16
        seen[r.sequence_id] |= spot
    assert sorted(r.n for r in rows) == list(range(400)) and all(len(s) == max(s) + 1 for s in seen.values())
    monkeypatch.setattr(C, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, C.pack(pieces, capacity=16).collect())) == sorted(map(tuple, rows))
