from llm import brute
import numpy as np

from starweave.llm import quality as Q
from starweave.llm.common import table

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_quality(spark, rows_of):
    rows = {r.doc_id: r for r in Q.query(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    labels = {r["doc_id"]: r["quality"] for r in rows_of("labels", SF)}
    held = [(labels[i], r.score) for i, r in rows.items() if i in labels and r.held_out]
    y, s = (np.array(x) for x in zip(*held))
    rank = (s[y == 1][:, None] > s[y == 0][None, :]).mean() + (s[y == 1][:, None] == s[y == 0][None, :]).mean() / 2
    assert rank > 0.97, rank
    assert ((s >= 0.5) == y).mean() > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (brute.crc(i) % 3 == 1) for i, r in rows.items())


def good(i):
    return " ".join(["the river ran past", "an old mill and", "some quiet fields where", "people walked home"][(i + k) % 4] for k in range(12))


def test_edges(spark, make_docs):
    rows = [(i, good(i) if i % 2 else "spam!! " * (20 + i)) for i in range(120)]
    extra = [(200, None), (201, ""), (202, " \n"), (None, good(1)), (203, "spam!! " * 300000), (5, good(5)), (204, good(2) * 5000)]
    docs = make_docs(rows + extra).selectExpr("*", "1 AS score", "2 AS y", "3 AS x")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)] + [(None, 1, 0), (7, None, None), (3, 7, 0), (9, 0, 0)], LABELS)
    got = Q.query(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    assert by[200].score == by[201].score == by[202].score
    assert by[203].predicted == 0 and by[204].predicted == 1 and by[None].predicted == 1 and by[None].held_out is False


def test_held_out_labels_teach_nothing(spark, make_docs):
    docs = make_docs([(i, good(i) if i % 2 else "spam!! " * (20 + i)) for i in range(60)])
    label = lambda flip: spark.createDataFrame([(i, 1 - i % 2 if flip and brute.crc(i) % 3 == 1 else i % 2, 0) for i in range(60)], LABELS)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(Q.query(docs, label(False))) == key(Q.query(docs, label(True)))


def test_nothing_to_learn_from(spark, make_docs):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in Q.query(make_docs([(1, "a b")]), none).collect()] == [0.5]
    assert Q.query(make_docs([]), none).collect() == []


def test_pooling_in_parts_and_word_vectors(spark, make_docs, monkeypatch):
    vectors = Q.word_vectors(make_docs([(i, good(i)) for i in range(30)]))
    assert vectors.shape == (Q.SLOTS, Q.DIMS) and np.isfinite(vectors).all()
    whole = Q.pooled(good(3), vectors)
    monkeypatch.setattr(Q, "CHUNK", 5)
    np.testing.assert_allclose(Q.pooled(good(3), vectors), whole, rtol=1e-5, atol=1e-6)
    s, kind, length = Q.slots("Ab cd!! 12 Ab")
    assert s[0] == s[4] and kind.tolist() == [2, 1, 4, 3, 2] and length.tolist() == [2, 2, 2, 2, 2]


def plain_words(text):
    """(slot, kind, length) of each word, one character at a time."""
    kind = lambda c: 0 if c.isspace() else (2 if c.isupper() else 1) if c.isalpha() else 3 if c.isdigit() else 4
    out, at = [], 0
    while at < len(text):
        sort, end, h = min(kind(text[at]), 1) if kind(text[at]) < 3 else kind(text[at]), at, 0
        while end < len(text) and (min(kind(text[end]), 1) if kind(text[end]) < 3 else kind(text[end])) == sort:
            x = (ord(text[end]) + 1) * 0x9E3779B97F4A7C15 % 2**64
            x = (x ^ (x >> 29)) * (2 * (end - at) + 0xBF58476D1CE4E5B9) % 2**64
            h = (h + (x ^ (x >> 32))) % 2**64
            end += 1
        if sort:
            out.append(((h * 0x9E3779B97F4A7C15 % 2**64 >> 52) % Q.SLOTS, kind(text[at]), end - at))
        at = end
    return out


def plain_vectors(texts):
    """Random-indexing vectors from sums over each word's neighbours, one pair at a time."""
    index = Q.index_vectors().astype(float)
    near = np.zeros((Q.SLOTS, Q.DIMS))
    for t in texts:
        s = [w[0] for w in plain_words(t or "")]
        for i in range(len(s)):
            for j in range(max(0, i - Q.WINDOW), min(len(s), i + Q.WINDOW + 1)):
                if i != j:
                    near[s[i]] += index[s[j]]
    shared = near.sum(axis=0) / max(1.0, np.abs(near).sum())
    for row in near:
        row -= shared * np.abs(row).sum()
        row[:] = np.sign(row) * np.sqrt(np.abs(row))
        length = np.sqrt((row**2).sum())
        row /= length or 1
    return near


def plain_pooled(text, vectors):
    words = plain_words(text or "")
    if not words:
        return np.zeros(Q.POOLED)
    own = np.array([vectors[s] for s, _, _ in words])
    pairs = list(zip(words, words[1:]))
    product = sum((vectors[a[0]] * vectors[b[0]] for a, b in pairs), np.zeros(Q.DIMS)) / max(1, len(pairs))
    n = len(words)
    more = [sum(k == kind for _, k, _ in words) / n for kind in (1, 2, 3, 4)]
    more += [sum(a[0] == b[0] for a, b in pairs) / n, len({s for s, _, _ in words}) / min(n, Q.SLOTS), np.log1p(n) / 10, np.log1p(sum(w[2] for w in words) / n) / 3]
    return np.concatenate([own.mean(axis=0), own.std(axis=0), product, more])


def plain_network(x, y):
    """The network trained row by row with Adam, and its temperature; gives the score of a row."""
    rng = np.random.default_rng(11)
    held = [i for i in range(len(y)) if i % 5 == 0]
    rest = [i for i in range(len(y)) if i % 5]
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / spread
    params = [rng.normal(0, 1 / np.sqrt(Q.POOLED), (Q.POOLED, Q.HIDDEN)), np.zeros(Q.HIDDEN), rng.normal(0, 1 / np.sqrt(Q.HIDDEN), Q.HIDDEN), np.zeros(1)]
    first, second, step = [p * 0 for p in params], [p * 0 for p in params], 0

    def logit(row):
        hidden = np.tanh(row @ params[0] + params[1])
        return hidden, float(hidden @ params[2] + params[3][0])

    for _ in range(Q.EPOCHS):
        order = rng.permutation(len(rest))
        for at in range(0, len(order), 64):
            batch = [rest[i] for i in order[at : at + 64]]
            grads = [1e-3 * params[0], np.zeros(Q.HIDDEN), 1e-3 * params[2], np.zeros(1)]
            for i in batch:
                hidden, s = logit(z[i])
                error = (1 / (1 + np.exp(-s)) - y[i]) / len(batch)
                inner = error * params[2] * (1 - hidden**2)
                for grad, part in zip(grads, (np.outer(z[i], inner), inner, error * hidden, np.array([error]))):
                    grad += part
            step += 1
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                params[k] = params[k] - 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    ones = sum(y[i] for i in held)
    target = {1: (ones + 1) / (ones + 2), 0: 1 / (len(held) - ones + 2)}

    def loss(t):
        s = [(logit(z[i])[1] / t, target[int(y[i])]) for i in held]
        return sum(g * np.log1p(np.exp(-v)) + (1 - g) * np.log1p(np.exp(v)) for v, g in s)

    grid = [np.exp(np.log(0.2) + i * (np.log(10) - np.log(0.2)) / 79) for i in range(80)]
    t = min(grid, key=loss)
    return lambda row: 1 / (1 + np.exp(-logit((row - mean) / spread)[1] / t))


def test_equals_a_plain_version(spark, make_docs):
    import random
    import zlib

    rnd = random.Random(5)
    fine, poor = "The river ran past an old Mill, and 3 quiet fields.".split(), "BUY now!!! $$$ click click 100% free zzz".split()
    docs, labels = [], []
    for i in range(110):
        y = i % 2
        pool = (fine if y else poor) + (poor if y else fine)[: rnd.randint(0, 7)]  # mixed, so that scores are not all 0 and 1
        docs.append((i, " ".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12)))))
        labels.append((i, y if rnd.random() < 0.9 else 1 - y, 0))
    docs += [(300, None), (301, ""), (302, "Unlabelled words, 7 of them!")]
    vectors = plain_vectors([t for _, t in docs])
    np.testing.assert_allclose(Q.word_vectors(make_docs(docs)), vectors, atol=1e-5)
    features = {i: plain_pooled(t, vectors) for i, t in docs}
    taught = sorted((x for x in labels if brute.crc(x[0]) % 3 != 1), key=lambda x: (zlib.crc32(f"order {x[0]}".encode()), x[0]))
    assert len(taught) >= 50
    net = plain_network(np.array([features[i] for i, _, _ in taught]), np.array([float(y) for _, y, _ in taught]))
    got = {r.doc_id: r.score for r in Q.query(make_docs(docs), spark.createDataFrame(labels, LABELS)).collect()}
    assert set(got) == set(features)
    scores = [net(x) for x in features.values()]
    np.testing.assert_allclose([got[i] for i in features], scores, atol=0.01)
    assert min(scores) < 0.3 and max(scores) > 0.7
