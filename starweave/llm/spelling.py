"""Spelling variants by PartEnum signatures over letter multisets.

Words at an edit distance of one have letter multisets that differ in one element (a
letter too many) or two (a letter replaced). A multiset is a binary vector: its
elements are (letter, how often it came before). PartEnum (Arasu, Ganti, Kaushik,
"Efficient Exact Set-Similarity Joins", VLDB 2006) splits the dimensions into
``PARTS`` parts; vectors that differ in at most two dimensions agree on all parts but
two, whichever these are. So every word has one signature for each choice of two
parts left out: a fingerprint of its elements in the others and of its length. A word
that is one letter shorter comes to the signatures of the longer length too. Equal
signatures are joined by Spark, and a pair counts only if its words' edit distance is
one: unequal vectors never lose a signature, and fingerprints that agree by chance
are refused.

Words are counted inside the tasks before they are shuffled, so a word that fills a
third of all texts is a few rows; after that every word is one row. Each word follows
its form by pointer doubling, so the rounds grow with the logarithm of a chain's
length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.llm.common import save, texts

LETTERS = "a-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
PARTS = 6
_U64 = (1 << 64) - 1


def count_words(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, rewrite: Callable[[int | None], Callable[[str], str]] | None = None
) -> DataFrame:
    """(word, n): the runs of letters of at least ``min_length``, A to Z lowered, over all whole texts.

    ``rewrite(id)`` may give a function that replaces that document's words, by others
    that are not longer. Null and empty texts have no words.
    """
    runs = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def run(batches):
        for b in batches:
            counts: Counter = Counter()
            for i, t in zip(texts(b, "doc_id"), texts(b)):
                own = Counter(runs.findall((t or "").encode().lower().decode()))
                if rewrite and own:
                    change = rewrite(i)
                    for w, n in own.items():
                        counts[change(w)] += n
                else:
                    counts.update(own)
            got = [(w, n) for w, n in counts.items() if len(w) >= min_length]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in got], pa.string()), pa.array([n for _, n in got], pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Signatures:
    """PartEnum signatures of words, as 64-bit numbers; one for each choice of two parts."""

    def __init__(self, parts: int = PARTS):
        self.parts, self.elements = parts, {}
        self.left_out = list(combinations(range(parts), 2))

    def _element(self, letter: str, before: int) -> tuple[int, int]:
        """(part, fingerprint) of a dimension."""
        h = xxhash.xxh64_intdigest(f"{letter}{before}".encode(), seed=13)
        return (ord(letter) * 7 + before * 3) % self.parts, h

    def vectors(self, words: list[str]) -> np.ndarray:
        """For each word and part: the fingerprints of its elements, added up."""
        sums, known = [], self.elements
        for w in words:
            own, seen = [0] * self.parts, {}
            for c in w:
                e = (c, seen.get(c, 0))
                seen[c] = e[1] + 1
                if e not in known:
                    known[e] = self._element(*e)
                part, h = known[e]
                own[part] += h
            sums.append([x & _U64 for x in own])
        return np.array(sums, dtype=np.uint64).reshape(-1, self.parts)

    def of(self, words: list[str], lengths: np.ndarray) -> np.ndarray:
        """A row of signatures for each word, as if it had the given length."""
        vectors = self.vectors(words)
        total = vectors.sum(axis=1, dtype=np.uint64)
        out = np.empty((len(words), len(self.left_out)), dtype=np.uint64)
        for k, (a, b) in enumerate(self.left_out):
            x = total - vectors[:, a] - vectors[:, b]
            x ^= (lengths.astype(np.uint64) * np.uint64(len(self.left_out)) + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            out[:, k] = x ^ (x >> np.uint64(32))
        return out.view(np.int64)


def signed(words: DataFrame, longer: bool, end: int, parts: int = PARTS) -> DataFrame:
    """(sig, word, n, head, tail) of every (word, n): one row a signature; ``longer``: those of one letter more as well.

    ``head`` and ``tail`` are fingerprints of the first and last ``end`` letters.
    """

    def run(batches):
        made = Signatures(parts)
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                w = texts(part, "word")
                size = np.array([len(x) for x in w], dtype=np.int64)
                sig = np.concatenate([made.of(w, size + k) for k in ((0, 1) if longer else (0,))], axis=1)
                row = pa.array(np.repeat(np.arange(len(w)), sig.shape[1]))
                ends = [pa.array([zlib.crc32(e(x).encode()) - (1 << 31) for x in w], pa.int32()) for e in (lambda x: x[:end], lambda x: x[-end:])]
                yield pa.RecordBatch.from_arrays([pa.array(sig.ravel()), *(c.take(row) for c in (part.column(0), part.column(1), *ends))], names=["sig", "word", "n", "head", "tail"])

    return words.select("word", "n").mapInArrow(run, "sig long, word string, n long, head int, tail int")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, parts: int = PARTS) -> DataFrame:
    """(word, near, near_n): all pairs of words of (word, n) at an edit distance of one, both ways round, once each.

    ``words`` are of ``min_length`` letters or more, each once. An edit leaves the first or the last half of
    that length as it is, which is asked before the distance is computed.
    """
    end = min_length // 2
    a = signed(words, longer=False, end=end, parts=parts).alias("a")
    b = signed(words, longer=True, end=end, parts=parts).alias("b")
    once = (F.length("b.word") < F.length("a.word")) | (F.col("b.word") < F.col("a.word"))
    ends = (F.col("a.head") == F.col("b.head")) | (F.col("a.tail") == F.col("b.tail")) if end else F.lit(True)
    near = ends & once & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    pairs = a.join(b, (F.col("a.sig") == F.col("b.sig")) & near)
    pairs = pairs.select(F.explode(F.array(
        F.struct(F.col("a.word").alias("word"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")),
        F.struct(F.col("b.word").alias("word"), F.col("a.word").alias("near"), F.col("a.n").alias("near_n")),
    )).alias("p")).select("p.*")
    return pairs.distinct()


def follow(links: DataFrame) -> DataFrame:
    """(word, root) for every (word, form): the last word of the chain of forms. Chains have no cycles."""
    cur = save(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while cur.where("moved").limit(1).count():
        nxt = cur.select(F.col("word").alias("_sw_w"), F.col("root").alias("_sw_r"))
        joined = cur.join(nxt, F.col("root") == F.col("_sw_w"), "left")
        cur = save(joined.select("word", F.coalesce("_sw_r", "root").alias("root"), F.col("_sw_r").isNotNull().alias("moved")), "roots")
    return cur.select("word", "root")


def group_variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO, parts: int = PARTS) -> DataFrame:
    """word, n, n_near, form, form_n, root for every row of ``words`` (word, n; each word once, a written table).

    ``form`` is the near word of largest n (of equal ones the first in code-point
    order) if that is ``ratio`` times the word's n at least, which it must be more than
    one to keep chains from turning round. ``root`` is the end of the chain of forms.
    """
    if ratio < 2:
        raise ValueError("forms have to be more frequent than their variants")
    near = near_words(words, min_length, parts)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    linked = save(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "variants")
    roots = follow(linked.where("form is not null"))
    return linked.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def misspelt(doc_id: int | None) -> Callable[[str], str]:
    """The contract's damage to a document's words: where 199 divides a word's crc32, one letter goes. A null id counts as empty."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), start)
        if h % 199:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1 :]

    return change


def query(docs: DataFrame) -> DataFrame:
    """op13: the words of all documents with their variants.

    Null, empty and white texts have no words; repeated rows and ids count again; very
    long texts and words are taken whole; further columns go; a table without rows, or
    one whose words are all short or rare, gives no rows.
    """
    words = save(count_words(docs, rewrite=misspelt).where(F.col("n") >= MIN_COUNT), "words")
    return group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")
