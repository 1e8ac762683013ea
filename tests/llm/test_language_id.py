from llm import brute
import numpy as np

from starweave.llm import language_id as L
from starweave.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_calibration(spark, rows_of):
    rows = {r.doc_id: r for r in L.query(table(spark, SF, "documents")).collect()}
    docs = rows_of("documents", SF)
    assert len(rows) == len(docs)
    right = []
    for d in docs:
        r = rows[d["doc_id"]]
        assert r.held_out == (brute.crc(d["doc_id"]) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out and d["lang"]:
            right.append((r.lang_pred == d["lang"], r.score))
    assert np.mean([x for x, _ in right]) > 0.97
    assert abs(np.mean([x for x, _ in right]) - np.mean([s for _, s in right])) < 0.05


def test_edges(spark, make_docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the and of that", "en"), ("der die und das", "de")] * 20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 !! 34", "en"), (103, "the that and", None), (None, "und die der", "de"), (104, "der und " * 50000, None), (5, "die das", "de"), (5, "die das", "de")]
    docs = make_docs(rows).selectExpr("*", "1 AS lang_pred", "2 AS score", "3 AS id")
    got = L.query(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102, 103, 104, None)] == ["und", "und", "und", "en", "de", "de"]
    assert by[100].score == 0.0 and by[None].held_out is False


def test_no_labels_and_no_rows(spark, make_docs):
    assert {r.lang_pred for r in L.query(make_docs([(1, "some text", None), (2, "more", None)])).collect()} == {"und"}
    assert L.query(make_docs([])).collect() == []


def test_held_out_labels_teach_nothing(spark, make_docs):
    rows = [(i, "the and of that with", "en") for i in range(40)] + [(i, "der die und das mit", "de") for i in range(40, 80)]
    swapped = [(i, t, "xx" if brute.crc(i) % 4 == 2 else lang) for i, t, lang in rows]
    key = lambda df: sorted(tuple(r) for r in L.query(df).collect())
    assert key(make_docs(rows)) == key(make_docs(swapped))


def test_stage_drops_texts_without_letters(spark, make_docs):
    docs = make_docs([(i, "the and of that with", "en") for i in range(40)] + [(50, "123"), (51, None)]).selectExpr("*", "1 AS lang_pred")
    out = L.keep_known(spark, docs, SF)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == set(range(40))


def plain_ngrams(text):
    """Counts of hashed 1- to 3-grams, one character at a time."""
    import re

    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    if not letters.strip():
        return None
    padded = " " + re.sub(" +", " ", letters).lstrip(" ") + " "
    counts = {}
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            h = n * 40503
            for k in range(n):
                h = (h ^ ord(padded[i + k])) * (2654435761, 2246822519, 3266489917)[k] % 2**32
                h ^= h >> 15
            counts[h % L.DIMS] = counts.get(h % L.DIMS, 0) + 1
    return counts


def plain_model(rows):
    """Document frequencies, FTRL one coordinate at a time, and a temperature, from (id, text, lang) in the order of training."""
    from math import exp, log, sqrt

    grams = [(plain_ngrams(t), lang) for _, t, lang in rows]
    grams = [(g, lang) for g, lang in grams if g]
    idf = {f: log((1 + len(grams)) / (1 + sum(f in g for g, _ in grams))) + 1 for f in {f for g, _ in grams for f in g}}
    unseen = log(1 + len(grams)) + 1

    def vector(g):
        x = {f: (1 + log(c)) * idf.get(f, unseen) for f, c in g.items()}
        norm = sqrt(sum(v * v for v in x.values()))
        return {f: v / norm for f, v in x.items()} | {"bias": 1.0}

    langs = sorted({lang for _, lang in grams})
    data = [(vector(g), langs.index(lang)) for g, lang in grams]
    held, fit = data[::5], [d for i, d in enumerate(data) if i % 5]
    z, n = {}, {}

    def weight(f, c):
        zz, nn = z.get((f, c), 0.0), n.get((f, c), 0.0)
        rate = (L.BETA + sqrt(nn)) / L.ALPHA
        if f == "bias":
            return -zz / rate
        return 0.0 if abs(zz) <= L.L1 else -(zz - (L.L1 if zz > 0 else -L.L1)) / (rate + L.L2)

    def odds(x, t=1.0):
        s = [sum(v * weight(f, c) for f, v in x.items()) / t for c in range(len(langs))]
        e = [exp(v - max(s)) for v in s]
        return [v / sum(e) for v in e]

    order = np.random.default_rng(1)
    for _ in range(L.EPOCHS):
        for i in order.permutation(len(fit)):
            x, y = fit[i]
            p = odds(x)
            steps = {(f, c): (v * (p[c] - (c == y)), weight(f, c)) for f, v in x.items() for c in range(len(langs))}
            for at, (g, w) in steps.items():
                before = n.get(at, 0.0)
                z[at] = z.get(at, 0.0) + g - (sqrt(before + g * g) - sqrt(before)) / L.ALPHA * w
                n[at] = before + g * g
    grid = [exp(log(0.05) + i * (log(20.0) - log(0.05)) / 120) for i in range(121)]
    t = min(grid, key=lambda t: sum(-log(max(odds(x, t)[y], 1e-12)) for x, y in held))

    def predict(text):
        g = plain_ngrams(text)
        p = odds(vector(g), t) if g else None
        return (langs[p.index(max(p))], max(p)) if p else ("und", 0.0)

    return predict


def test_equals_a_plain_version(spark, make_docs):
    import random
    import zlib

    rnd = random.Random(3)
    words = {"en": "the and of that with river Mill HOUSE".split(), "de": "der die und das mit Fluß Mühle haus".split(), "fr": "le la et des avec rivière moulin maison".split()}
    docs = []
    for i in range(120):
        lang = rnd.choice(sorted(words))
        pool = words[lang] + words[rnd.choice(sorted(words))][: rnd.randint(0, 8)]  # mixed, so that probabilities are not all one
        docs.append((i, "  ".join(rnd.choice(pool) for _ in range(rnd.randint(1, 5))) + rnd.choice(["", " 12", "!", "  "]), lang))
    docs += [(500, None, "en"), (501, "77", "de"), (502, "la house und the", None)]
    taught = [d for d in docs if brute.crc(d[0]) % 4 != 2 and d[1] is not None and d[2] is not None]
    taught.sort(key=lambda d: (zlib.crc32(f"order {d[0]}".encode()), str(d[0])))
    predict = plain_model(taught)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.query(make_docs(docs)).collect()}
    scores = []
    for i, text, _ in docs:
        lang, score = predict(text)
        assert got[i][0] == lang
        assert abs(got[i][1] - score) < 1e-4, i
        scores.append(score)
    assert min(s for s in scores if s) < 0.9 < max(scores)
