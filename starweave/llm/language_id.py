"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Text is lower-cased, runs of non-letters become one space, and the 1- to
3-grams of the result are hashed into ``DIMS`` features. Document frequencies
are counted over every training row. The regression is trained by
follow-the-regularised-leader (per-coordinate rates, elastic net) on a bounded
sample of labelled rows: at most ``SAMPLE_PER_LANG`` of each language, those
with the smallest hash of their id. A temperature, fitted on a fifth of that
sample which the regression doesn't see, calibrates the probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.llm.common import BROADCAST_ROWS, add_columns, bounded_sample, map_batches, pieces, remainder, save, texts, unused

DIMS = 1 << 14
ORDERS = (1, 2, 3)
SAMPLE_PER_LANG = 800
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.002
MIN_SCORE = 0.35  # the pipeline rejects documents below it
UNDETERMINED = "und"
_MULTIPLIERS = (2654435761, 2246822519, 3266489917)  # odd 32-bit hash multipliers
_FOLD: list = []


def _fold() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    if not _FOLD:
        out = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(out)
    return _FOLD[0]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(feature numbers, counts) of a whole text; None if it has no letter."""
    counts = np.zeros(DIMS, dtype=np.int64)
    for part in pieces(text) if text else ():
        codes = _fold()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        space = codes == 32
        if space.all():
            continue
        keep = ~space
        keep[1:] |= ~space[:-1]
        codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
        for n in ORDERS:
            h = np.full(len(codes) - n + 1, n * 40503, dtype=np.uint32)
            for k in range(n):
                h = (h ^ codes[k : len(codes) - n + 1 + k]) * np.uint32(_MULTIPLIERS[k])
                h ^= h >> np.uint32(15)
            counts += np.bincount(h & np.uint32(DIMS - 1), minlength=DIMS)
    if not counts.any():
        return None
    at = np.flatnonzero(counts)
    return at, counts[at]


def weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(counts)) * idf[at]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list, langs: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL over ``rows`` of (feature numbers, counts, class); weights, bias and temperature."""
    k = len(langs)
    z, n = np.zeros((DIMS + 1, k)), np.zeros((DIMS + 1, k))  # the last row is the bias, unpenalised
    data = [(np.append(at, DIMS), np.append(weigh(at, c, idf), 1.0), y) for at, c, y in rows]
    held = data[::5] if len(data) >= 50 else data
    fit = [r for i, r in enumerate(data) if i % 5] if len(data) >= 50 else data

    def weights(zz, nn, free):
        w = -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2)
        w[np.abs(zz) <= L1] = 0.0
        if free:
            w[-1] = -zz[-1] / ((BETA + np.sqrt(nn[-1])) / ALPHA)
        return w

    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(fit)):
            at, x, y = fit[i]
            zz, nn = z[at], n[at]
            w = weights(zz, nn, True)
            g = softmax(x @ w)
            g[y] -= 1.0
            g = x[:, None] * g[None, :]
            root = np.sqrt(nn + g * g)
            z[at] = zz + g - (root - np.sqrt(nn)) / ALPHA * w
            n[at] = nn + g * g
    w = weights(z, n, True)
    logits = np.array([x @ w[at] for at, x, _ in held]).reshape(-1, k)
    ys = np.array([y for _, _, y in held], dtype=int)

    def loss(t: float) -> float:
        p = softmax(logits / t)[np.arange(len(ys)), ys]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
    t = float(min(grid, key=loss)) if len(ys) else 1.0
    return w[:-1].astype(np.float32), w[-1].astype(np.float32), t


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict:
    """A model from every row of ``docs`` that has a language. Bounded: DIMS x languages."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text is not null")

    def frequencies(batches):
        df, n = np.zeros(DIMS, dtype=np.int64), 0
        for b in batches:
            for t in texts(b):
                if (f := features(t)) is not None:
                    df[f[0]] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], names=["at", "n"])

    df = dict(map_batches(rows.select("text"), frequencies, "at int, n long").groupBy("at").agg(F.sum("n")).collect())
    total = df.pop(-1, 0)
    idf = np.full(DIMS, np.log(1.0 + total) + 1.0)
    for at, n in df.items():
        idf[at] = np.log((1.0 + total) / (1.0 + n)) + 1.0

    chosen = save(bounded_sample(rows, "lang", ["id"], SAMPLE_PER_LANG), "language-sample")
    # SAMPLE_PER_LANG rows a language; languages are counted, since labels may be anything
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    sample = rows.join(chosen, ["id", "lang"], "left_semi")

    def featurise(b):
        found = [features(t) or (None, None) for t in texts(b)]
        return [pa.array([None if a is None else a.astype(np.int32) for a, _ in found], pa.list_(pa.int32())), pa.array([None if a is None else c for a, c in found], pa.list_(pa.int64()))]

    sample = add_columns(sample, [T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.LongType()))], featurise, keep=["id", "lang"]).where("at is not null")
    # a repeated id teaches once a language
    sample = sample.groupBy("id", "lang").agg(F.min(F.struct("at", "n")).alias("f")).select("id", "lang", "f.at", "f.n")

    def learn(batches):
        # the lists stay arrays over the batches: as Python's numbers they take several times the memory
        got = []
        for b in batches:
            lists = [[x.values.to_numpy(zero_copy_only=False) for x in b.column(i)] for i in (2, 3)]
            got.extend(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), *lists))
        got.sort(key=lambda r: (hash_of(r[0]), str(r[0]), r[1]))  # an id comes once a language
        langs = sorted({r[1] for r in got})
        if langs:
            data = [(at, n, langs.index(lang)) for _, lang, at, n in got]
            w, b, t = train(data, langs, idf)
            yield pa.RecordBatch.from_arrays([pa.array([langs], pa.list_(pa.string())), pa.array([w.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary()), pa.array([t])], names=["langs", "w", "b", "t"])

    got = map_batches(sample.repartition(1), learn, "langs array<string>, w binary, b binary, t double").first()
    if got is None:
        return {"langs": [], "idf": idf.astype(np.float32), "w": np.zeros((DIMS, 0), np.float32), "b": np.zeros(0, np.float32), "t": 1.0}
    k = len(got["langs"])
    w = np.frombuffer(bytes(got["w"]), dtype=np.float32).reshape(DIMS, k)
    return {"langs": list(got["langs"]), "idf": idf.astype(np.float32), "w": w, "b": np.frombuffer(bytes(got["b"]), dtype=np.float32), "t": got["t"]}


def hash_of(value) -> int:
    """A fixed order of ids that has nothing to do with their size."""
    import zlib

    return zlib.crc32(f"order {value}".encode())


def predict(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds the predicted language and its calibrated probability.

    Null texts, texts without a letter, and every text if no language was
    learned: `und` with score 0.
    """
    langs, idf, w, b, t = (model[x] for x in ("langs", "idf", "w", "b", "t"))

    def run(batch):
        out, scores = [], []
        for s in texts(batch, text):
            f = features(s) if langs else None
            if f is None:
                out.append(UNDETERMINED)
                scores.append(0.0)
                continue
            x = weigh(*f, idf).astype(np.float32)
            p = softmax((x @ w[f[0]] + b).astype(np.float64) / t)
            out.append(langs[int(p.argmax())])
            scores.append(float(min(1.0, p.max())))
        return [pa.array(out, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(docs, [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())], run, keep)


def query(docs: DataFrame) -> DataFrame:
    """op5: doc_id, held_out, lang_pred, score of every row. A null id is not held out and teaches nothing."""
    rows = docs.select("doc_id", "text", "lang")
    held = remainder(F.col("doc_id"), 4) == 2
    model = fit(rows.where(~held))
    found = predict(rows.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_known(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drops documents without a letter or whose language is uncertain (score under MIN_SCORE).

    Learns as op5 does, from the labelled rows of ``docs`` that are not held out.
    """
    held = remainder(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held))
    a, b = unused(docs, "lang_pred"), unused(docs, "score")
    scored = predict(docs, model, names=(a, b))
    return scored.where((F.col(a) != UNDETERMINED) & (F.col(b) >= MIN_SCORE)).select(*docs.columns)
