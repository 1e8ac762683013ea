import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starweave.llm import spelling as W
from starweave.llm.common import save, table

SF = "/root/testdata/sf0.001"


def is_near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_words(docs, min_length=6, min_count=5):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: k for w, k in n.items() if k >= min_count and len(w) >= min_length}


def brute_variants(n, ratio=5):
    shorter = {}  # candidates by deletion neighbourhoods, which the operator knows nothing of
    for w in n:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shorter.setdefault(x, set()).add(w)
    near = {w: {v for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for v in shorter[x] if is_near(v, w)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] is not None else None) for w in n}


def test_brute_neighbours_against_all_pairs():
    rnd = random.Random(1)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(6, 8))) for _ in range(150)}
    got = brute_variants(dict.fromkeys(words, 5))
    assert {(w, k) for w, _, _, _, k, _ in got} == {(w, sum(is_near(w, v) for v in words)) for w in words}


def test_whole_table(spark, rows_of):
    got = W.query(table(spark, SF, "documents"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    docs = [(d["doc_id"], d["text"]) for d in rows_of("documents")]
    want = brute_variants(brute_words(docs))
    assert {tuple(r) for r in got.collect()} == want and sum(r[4] for r in want) > 200 and got.count() == len(want)


@pytest.mark.parametrize("parts", [3, 6, 9])
def test_no_pair_is_lost(spark, parts):
    rnd = random.Random(parts)
    words = {"".join(rnd.choice("aabcéÿ") for _ in range(rnd.randint(6, 9))) for _ in range(900)}
    words |= {w + w[:1] for w in list(words)[:100]} | {w[::-1] for w in list(words)[:100]}  # anagrams
    n = {w: rnd.choice([5, 6, 30, 31, 200, 1200, 9000]) for w in words}
    df = save(spark.createDataFrame(list(n.items()), "word string, n long"), "test-words")
    assert {tuple(r) for r in W.group_variants(df, parts=parts).select("word", "form", "root", "n", "n_near", "form_n").collect()} == brute_variants(n)


def test_signatures_meet_at_two_differences():
    rnd = random.Random(2)
    made = W.Signatures()
    for _ in range(500):
        w = "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(6, 12)))
        i = rnd.randrange(len(w))
        shorter, other = w[:i] + w[i + 1 :], w[:i] + rnd.choice("xyzab") + w[i + 1 :]
        sig = lambda x, up=0: set(made.of([x], np.array([len(x) + up]))[0].tolist())
        assert sig(w) & sig(shorter, 1) and sig(w) & sig(other)


def test_short_words_need_other_ends(spark):
    n = {"ab": 5, "b": 30, "abc": 200, "xbc": 6, "a": 5}
    df = save(spark.createDataFrame(list(n.items()), "word string, n long"), "test-words")
    assert {tuple(r) for r in W.group_variants(df, min_length=1).select("word", "form", "root", "n", "n_near", "form_n").collect()} == brute_variants(n)


def test_chains_and_ties(spark):
    n = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125, "akjihg": 20000, "abcdex": 25, "zzzzzz": 7}
    df = save(spark.createDataFrame(list(n.items()), "word string, n long"), "test-words")
    got = {r.word: r for r in W.group_variants(df).collect()}
    assert got["abcdef"].form == "abcdeg" and got["abcdef"].root == "akjihg" and got["zzzzzz"].root == "zzzzzz"
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.values()} == brute_variants(n)
    with pytest.raises(ValueError):
        W.group_variants(df, ratio=1)


def test_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "short a b"), (4, "AbÉcdef " * 7), (4, "AbÉcdef " * 7), (None, "abÉcdex " * 5), (5, "abcdefg,abcdefg;" * 30_000), (6, "ABCDEFGH1ABCDEFG " * 4), (7, "y" * 70_000 + " x" * 9)] + [(i, "z" * 2_000) for i in range(20, 27)]
    docs = make_docs(rows).selectExpr("*", "'w' AS word", "1 AS n", "2 AS sig")
    got = W.query(docs)
    assert {tuple(r) for r in got.collect()} == brute_variants(brute_words(rows)) and got.count() == len(brute_words(rows)) >= 3
    assert W.query(make_docs([])).collect() == [] and W.query(make_docs(rows[:3])).collect() == []
