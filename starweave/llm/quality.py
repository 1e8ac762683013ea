"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Words (runs of letters, of digits, or of other signs) are hashed into ``SLOTS``
slots. Every slot has a fixed sparse index vector of +1 and -1; a slot's word
vector is the sum of the index vectors of the words around it, over all
documents of the corpus, damped and brought to unit length (random indexing). A
document is pooled into the mean and spread of its words' vectors, the mean
product of neighbouring ones (which shows repetition), and shares of kinds of
words. A numpy network with one hidden layer, trained with Adam on a bounded
sample of at most ``SAMPLE_PER_LABEL`` rows of each label (those with the smallest
hash of their id), gives the logit; a temperature fitted on a fifth of the sample
that the network doesn't see calibrates it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.llm.common import add_columns, bounded_sample, pieces, remainder, texts

SLOTS = 1 << 12
DIMS = 32
NONZERO = 4  # entries of an index vector
WINDOW = 2  # words on either side
HIDDEN = 24
SAMPLE_PER_LABEL = 2000
EPOCHS = 60
POOLED = 3 * DIMS + 8
CHUNK = 1 << 16  # words handled at once
_P = np.uint64(0x9E3779B97F4A7C15)
_KIND: list = []


def _kinds() -> np.ndarray:
    """For each code point: 0 space, 1 lower-case or other letter, 2 upper-case letter, 3 digit, 4 other sign."""
    if not _KIND:
        out = np.full(0x110000, 4, dtype=np.uint8)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isspace():
                out[c] = 0
            elif ch.isalpha():
                out[c] = 2 if ch.isupper() else 1
            elif ch.isdigit():
                out[c] = 3
        _KIND.append(out)
    return _KIND[0]


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(7)
    out = np.zeros((SLOTS, DIMS), dtype=np.float32)
    for row in out:
        at = rng.choice(DIMS, NONZERO, replace=False)
        row[at] = rng.choice((-1.0, 1.0), NONZERO)
    return out


def slots(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, kind, length) of every word of ``text``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = _kinds()[codes]
    sort = np.where(kind == 2, 1, kind)
    edge = np.ones(len(codes), dtype=bool)
    edge[1:] = sort[1:] != sort[:-1]
    start = np.flatnonzero(edge)
    length = np.diff(np.append(start, len(codes)))
    with np.errstate(over="ignore"):
        # a word's hash: the sum of its code points, mixed with their place in the word
        place = (np.arange(len(codes)) - np.repeat(start, length)).astype(np.uint64)
        h = (codes.astype(np.uint64) + np.uint64(1)) * _P
        h = (h ^ (h >> np.uint64(29))) * (place * np.uint64(2) + np.uint64(0xBF58476D1CE4E5B9))
        h = np.add.reduceat(h ^ (h >> np.uint64(32)), start) * _P
    word = sort[start] != 0
    return (h[word] >> np.uint64(52)).astype(np.int64) % SLOTS, kind[start][word], length[word]


def _around(index: np.ndarray, s: np.ndarray) -> np.ndarray:
    """For each word the sum of the index vectors of its neighbours."""
    total = np.zeros((len(s) + 1, DIMS), dtype=np.float32)
    np.cumsum(index[s], axis=0, out=total[1:])
    at = np.arange(len(s))
    return total[np.minimum(at + WINDOW + 1, len(s))] - total[np.maximum(at - WINDOW, 0)] - index[s]


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Random-indexing vectors of all slots, from every document. Bounded: SLOTS x DIMS."""
    index = index_vectors()

    def add(near: np.ndarray, held: list) -> None:
        s = np.concatenate(held) if held else np.zeros(0, int)
        if len(s):
            around = np.concatenate([_around(index, x) for x in held])
            order = np.argsort(s, kind="stable")
            s = s[order]
            first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            near[s[first]] += np.add.reduceat(around[order], first, axis=0)

    def count(batches):
        near = np.zeros((SLOTS, DIMS), dtype=np.float64)
        for b in batches:
            held, words = [], 0
            for t in texts(b, text):
                for part in pieces(t) if t else ():
                    held.append(slots(part)[0])
                    words += len(held[-1])
                    if words > CHUNK:
                        add(near, held)
                        held, words = [], 0
            add(near, held)
        at = np.flatnonzero(near.any(axis=1))
        # whole numbers: sums are the same in any order
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *[pa.array(np.rint(near[at, d]).astype(np.int64)) for d in range(DIMS)]], names=["slot", *[f"d{d}" for d in range(DIMS)]])

    parts = docs.select(text).mapInArrow(count, "slot int, " + ", ".join(f"d{d} long" for d in range(DIMS)))
    sums = parts.groupBy("slot").agg(*[F.sum(f"d{d}").alias(f"d{d}") for d in range(DIMS)])
    out = np.zeros((SLOTS, DIMS), dtype=np.float64)
    for r in sums.collect():  # at most SLOTS rows
        out[r[0]] = r[1:]
    out -= out.sum(axis=0) / max(1.0, np.abs(out).sum()) * np.abs(out).sum(axis=1, keepdims=True)  # what all words share tells nothing
    out = np.sign(out) * np.sqrt(np.abs(out))
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return (out / np.where(norm == 0, 1, norm)).astype(np.float32)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Features of a whole text; zeros for none."""
    out = np.zeros(POOLED, dtype=np.float32)
    n, letters, same, seen = 0, 0, 0, np.zeros(SLOTS, dtype=bool)
    total, squares, product, shares = np.zeros(DIMS), np.zeros(DIMS), np.zeros(DIMS), np.zeros(4)
    for part in pieces(text) if text else ():
        s, kind, length = slots(part)
        n += len(s)
        letters += int(length.sum())
        same += int((s[1:] == s[:-1]).sum())
        seen[s] = True
        shares += np.bincount(kind, minlength=5)[1:5]
        for i in range(0, len(s), CHUNK):
            v = vectors[s[i : i + CHUNK + 1]]
            own = v[:CHUNK]
            total += own.sum(axis=0)
            squares += np.einsum("ij,ij->j", own, own)
            product += np.einsum("ij,ij->j", v[:-1], v[1:])
    if n:
        mean = total / n
        out[:DIMS] = mean
        out[DIMS : 2 * DIMS] = np.sqrt(np.maximum(squares / n - mean * mean, 0))
        out[2 * DIMS : 3 * DIMS] = product / max(1, n - 1)
        out[3 * DIMS :] = [*(shares / n), same / n, seen.sum() / min(n, SLOTS), np.log1p(n) / 10, np.log1p(letters / n) / 3]
    return out


def train(x: np.ndarray, y: np.ndarray) -> dict:
    """Two-layer network with Adam, then a temperature on the held part."""
    rng = np.random.default_rng(11)
    hold = np.arange(len(y)) % 5 == 0 if len(y) >= 50 else np.zeros(len(y), dtype=bool)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / spread
    fit, held = (z[~hold], y[~hold]), (z[hold], y[hold]) if hold.any() else (z, y)
    w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(fit[1]))
        for i in range(0, len(order), 64):
            a, b = fit[0][order[i : i + 64]], fit[1][order[i : i + 64]]
            h = np.tanh(a @ w[0] + w[1])
            p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30)))
            g = (p - b) / len(b)
            back = g[:, None] * w[2][None, :] * (1 - h * h)
            grads = [a.T @ back + 1e-3 * w[0], back.sum(axis=0), h.T @ g + 1e-3 * w[2], np.array([g.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                w[k] = w[k] - 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    logit = np.tanh(held[0] @ w[0] + w[1]) @ w[2] + w[3]
    grid = np.exp(np.linspace(np.log(0.2), np.log(10), 80))

    # targets a little off 0 and 1 (Platt), so that a part without errors doesn't ask for certainty
    n1 = held[1].sum()
    target = np.where(held[1] == 1, (n1 + 1) / (n1 + 2), 1 / (len(held[1]) - n1 + 2))

    def loss(t: float) -> float:
        return float((target * np.logaddexp(0, -logit / t) + (1 - target) * np.logaddexp(0, logit / t)).mean())

    return {"mean": mean, "spread": spread, "w": w, "t": min(grid, key=loss)}


def score(x: np.ndarray, net: dict | None) -> np.ndarray:
    if net is None:
        return np.full(len(x), 0.5)
    w = net["w"]
    z = np.tanh((x - net["mean"]) / net["spread"] @ w[0] + w[1]) @ w[2] + w[3]
    return 1 / (1 + np.exp(-np.clip(z / net["t"], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray) -> dict | None:
    """A network from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality); None without labelled rows.

    Only quality 0 and 1 count; a document labelled more than once has the
    larger of its labels.
    """
    marked = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    # ids that occur in the table, so that the bound counts rows with texts
    marked = marked.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = bounded_sample(marked, "y", ["doc_id"], SAMPLE_PER_LABEL)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * SAMPLE_PER_LABEL rows

    def features(b):
        return [pa.array([pooled(t, vectors).tolist() for t in texts(b)], pa.list_(pa.float32()))]

    rows = add_columns(sample, [T.StructField("x", T.ArrayType(T.FloatType()))], features, keep=["doc_id", "y"])
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y"), F.max("x").alias("x"))
    got = sorted(rows.collect(), key=lambda r: (hash_order(r[0]), r[0]))  # at most 2 * SAMPLE_PER_LABEL rows of POOLED numbers
    if not got:
        return None
    return train(np.array([r[2] for r in got], dtype=np.float64), np.array([r[1] for r in got]))


def hash_order(value) -> int:
    import zlib

    return zlib.crc32(f"order {value}".encode())


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op7: doc_id, held_out, score, predicted of every row.

    Without labels every score is 0.5. A null id is not held out and, like the
    held-out ids, teaches nothing. Null and empty texts are scored by their empty
    features.
    """
    docs = docs.select("doc_id", "text")
    held = remainder(F.col("doc_id"), 3) == 1
    vectors = word_vectors(docs)
    net = fit(docs.where(~held), labels.select("doc_id", "quality").where(~held), vectors)

    def run(b):
        rows = texts(b)
        x = np.array([pooled(t, vectors) for t in rows], dtype=np.float64).reshape(len(rows), POOLED)
        return [pa.array(score(x, net))]

    out = add_columns(docs, [T.StructField("score", T.DoubleType())], run, keep=["doc_id"])
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
