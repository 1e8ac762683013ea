"""Periodic runs of words by online dyadic square catching.

Words are appended one batch after another. For every power of two s, each
completed block of s words that starts at a multiple of s gets a catcher, which
watches the words 2s to 4s behind its start: when the s words that have just ended
are the block's, the text has matched itself at that distance, and a square of that
period may be there. A first half of 2s words or more holds a whole block, so no
square escapes. Each appended word thus takes part in two comparisons of suffixes a
size. They compare names: 64-bit fingerprints of the s words from a place on, each
made of two names of half the size.

Catches of one period by neighbouring blocks merge into a chain, which is extended
word by word (by halving sizes) to the run it lies in. All multiples of a period
have the same run, so the least period of a stretch is the run's. What is reported
is checked against the words themselves; if a fingerprint has lied, the text is done
again with other fingerprints.

A text is the work of one task; its memory is about 8 bytes a word and size. Texts
are spread over the tasks as they are read: there is no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.llm.common import add_columns, texts

MIN_LENGTH = 24
MIN_EXPONENT = 3
BATCH_WORDS = 1 << 17
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)


def _mixed(x: np.ndarray, y: np.ndarray, seed: int) -> np.ndarray:
    """Fingerprints of pairs of fingerprints."""
    odd = np.random.default_rng(seed).integers(0, 1 << 63, size=2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h = x * odd[0] + (y ^ (y >> np.uint64(29))) * odd[1]
    return h ^ (h >> np.uint64(32))


class SquareCatcher:
    """The runs of one sequence of word numbers: ``append`` any number of batches, then ask for ``runs``."""

    def __init__(self, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, seed: int = 0):
        if min_exponent < 2:
            raise ValueError("runs hold squares: their exponent is 2 or more")
        self.min_length, self.min_exponent, self.seed = min_length, min_exponent, seed
        self.words = np.zeros(0, dtype=np.int64)
        self.names: list[np.ndarray] = []  # by size: the name of the 2**size words from each place on
        self.chains: list[list[np.ndarray]] = []  # by size: rows (period, first block, number of blocks)

    def append(self, words: np.ndarray) -> None:
        self.words = np.concatenate([self.words, words])
        n = len(self.words)
        for k in count():
            s = 1 << k
            if k and (2 * s * self.min_exponent > n or n < self.min_length):
                break
            if k == len(self.names):
                self.names.append(np.zeros(0, dtype=np.uint64))
                self.chains.append([])
            old = self.names[k]
            at, end = len(old), n - s + 1
            if end <= at:
                break
            if k:
                half = self.names[k - 1]
                new = _mixed(half[at:end], half[at + s // 2 : end + s // 2], self.seed * 64 + k)
            else:
                new = _mixed(self.words[at:end].astype(np.uint64), np.zeros(end - at, dtype=np.uint64), self.seed * 64)
            self.names[k] = np.concatenate([old, new]) if at else new
            self._catch(k, at, end)

    def _catch(self, k: int, at: int, end: int) -> None:
        """Compares the suffixes that start in at..end with the blocks whose catchers watch there."""
        names, s = self.names[k], 1 << k
        found = []
        for back in (1, 2, 3) if k == 0 else (2, 3):
            first = max(at, back * s)
            if first >= end:
                continue
            blocks = names[((first >> k) - back) << k : ((((end - 1) >> k) - back) << k) + 1 : s]
            watched = np.repeat(blocks, s)[first % s :][: end - first]  # each block serves s suffixes in turn
            place = np.flatnonzero(names[first:end] == watched) + first
            start = ((place >> k) - back) << k
            found.append(np.stack([place - start, start], axis=1))
        hits = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
        if not len(hits):
            return
        hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
        chains = self._merged(np.column_stack([hits, np.ones(len(hits), dtype=np.int64)]), s)
        inside = (chains[:, 0] + chains[:, 1] >= at + s) & (chains[:, 0] + chains[:, 1] + chains[:, 2] * s < end - s)
        self.chains[k].append(chains[~inside | (chains[:, 2] >= self._blocks(chains[:, 0], s))])

    def _blocks(self, period: np.ndarray, s: int) -> np.ndarray:
        """The fewest whole blocks in a run of that period that is long enough."""
        return -(-(np.maximum(self.min_length - period, (self.min_exponent - 1) * period) - 2 * (s - 1)) // s)

    @staticmethod
    def _merged(chains: np.ndarray, s: int) -> np.ndarray:
        """Chains (sorted) of one period that follow each other become one."""
        new = np.ones(len(chains), dtype=bool)
        new[1:] = (chains[1:, 0] != chains[:-1, 0]) | (chains[1:, 1] != chains[:-1, 1] + chains[:-1, 2] * s)
        head = np.flatnonzero(new)
        return np.column_stack([chains[head, :2], np.add.reduceat(chains[:, 2], head)])

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) of each run, by start, then period."""
        n, best = len(self.words), {}
        for k, parts in enumerate(self.chains):
            chains = np.concatenate(parts) if parts else np.zeros((0, 3), dtype=np.int64)
            if not len(chains):
                continue
            s = 1 << k
            chains = self._merged(chains[np.lexsort((chains[:, 1], chains[:, 0]))], s)
            period, lo, blocks = chains[chains[:, 2] >= self._blocks(chains[:, 0], s)].T
            hi = lo + blocks * s
            for j in range(k - 1, -1, -1):  # less than s words are missing at either end
                t, names = 1 << j, self.names[j]
                more = np.flatnonzero(lo >= t)
                more = more[names[lo[more] - t] == names[lo[more] - t + period[more]]]
                lo[more] -= t
                more = np.flatnonzero(hi + period + t <= n)
                more = more[names[hi[more]] == names[hi[more] + period[more]]]
                hi[more] += t
            length = hi - lo + period
            long = length >= np.maximum(self.min_length, self.min_exponent * period)
            for a, size, p in zip(lo[long].tolist(), length[long].tolist(), period[long].tolist()):
                best[a, size] = min(p, best.get((a, size), p))
        return sorted(((a, size, p) for (a, size), p in best.items()), key=lambda r: (r[0], r[2]))

    def proved(self, runs: list[tuple[int, int, int]]) -> bool:
        """Whether the words themselves repeat in each run and stop doing so beside it."""
        w, n = self.words, len(self.words)
        return all(
            np.array_equal(w[a : a + size - p], w[a + p : a + size]) and (a == 0 or w[a - 1] != w[a - 1 + p]) and (a + size == n or w[a + size] != w[a + size - p])
            for a, size, p in runs
        )


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the numbered words, by start, then period."""
    for seed in count():
        catcher = SquareCatcher(min_length, min_exponent, seed)
        for at in range(0, len(words), BATCH_WORDS):
            catcher.append(words[at : at + BATCH_WORDS])
        if catcher.proved(found := catcher.runs()):
            return found


def numbered(words: list) -> np.ndarray:
    """Each word's number: equal words have equal numbers."""
    number: dict = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run repeats: its first period stays."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for a, size, p in runs:
        depth[a + p] += 1
        depth[a + size] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def mark_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    rewrite: Callable[[int | None, list], list] | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, runs (array of start, length, period), collapsed (the text without repeats).

    Words are what stands between ASCII white space; ``collapsed`` joins those
    that are kept by one blank. ``rewrite(id, words)`` may replace a text's words
    first. A null or empty text, or one of white space alone, has no words and no
    runs, and collapses to the empty text. Repeated rows and ids are rows like any
    other, a null id stays null, further columns go, and a table without rows gives
    none. Very long texts are taken whole; a run may end anywhere in them.
    """

    def marked(batch: pa.RecordBatch) -> list:
        spans, kept = [], []
        for i, t in zip(texts(batch, "doc_id"), texts(batch)):
            words = (t or "").encode().split()
            if rewrite:
                words = rewrite(i, words)
            runs = find_runs(numbered(words), min_length, min_exponent) if len(words) >= min_length else []
            spans.append([{"start": a, "length": size, "period": p} for a, size, p in runs])
            kept.append(b" ".join(collapse(words, runs)).decode())
        kind = pa.list_(pa.field("element", pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]), False))
        return [pa.array(spans, kind), pa.array(kept, pa.string())]

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return add_columns(rows, [T.StructField("runs", RUNS, False), T.StructField("collapsed", T.StringType(), False)], marked, keep=["doc_id"])


def planted(doc_id: int | None, words: list) -> list:
    """The contract's rewriting: of ids whose crc32 ends in 0, the words from some place on repeat (a null id: none)."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def strongest(runs: Column) -> Column:
    """The run of greatest length/period, compared exactly; of equal ones the first by start, then period. Null: no run."""
    none = F.lit(None).cast(RUNS.elementType)
    better = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    return F.aggregate(runs, none, better)


def query(docs: DataFrame) -> DataFrame:
    """op11: the runs of every document after the contract's rewriting, as digests."""
    rows = mark_runs(docs, rewrite=planted)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = rows.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
