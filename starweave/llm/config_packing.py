"""Best-fit packing by a configuration linear program over the length histogram.

Texts become token ids and are cut into pieces of at most ``CAPACITY`` tokens. A
configuration says how many pieces of each length share a sequence; the linear
program asks for the fewest sequences whose configurations hold all pieces, and
knows the corpus by its histogram alone (at most ``CAPACITY`` counts). It is solved
by multiplicative weights: every length has a price, a dynamic programme over the
capacity (a knapsack) finds the configurations of greatest price, those are bought in
steps, and the prices of the lengths they hold fall by a factor that grows with the
share of the pieces covered. The amounts are rounded down to whole sequences, the
program is solved again for the pieces left, and what the last rounding leaves is
packed by best fit, on the histogram too, so that none of this grows with the corpus.

The driver holds the histogram and the plan (at most ``ROUNDS * PASSES * COLUMNS``
configurations, and what best fit adds). Spark ranks the pieces of each length, in buckets of
bounded size, so that a common length is no single task, and every piece looks up
its sequence and offset by its length and rank.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.llm.common import BROADCAST_ROWS, add_columns, map_batches, save, texts

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
ROUNDS, PASSES, COLUMNS = 4, 48, 64
STEP = 0.15  # share of a length's pieces that one purchase covers at most
NEAR = 0.02  # how far below the greatest price a configuration may be
SPARE = 4  # of this many pieces at most this long a share of the capacity, one is kept for the last step
RATE = 2.0  # how fast a price falls with the share covered
BUCKET_ROWS = 1_000
REMEMBERED = 800_000
TOGETHER = 512
SLICE = 1 << 15


# ---------------------------------------------------------------- tokens and pieces


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit numbers.

    No token of this tokenizer crosses white space and it takes no notice of the case
    of A to Z, so what stands between ASCII white space is encoded once and remembered,
    up to ``REMEMBERED`` strings; so is a string of letters without the points behind it,
    since these are tokens of their own. New strings of letters are encoded many at a
    time, as the last token of each is marked as such. A text that may name special
    tokens, whose case does count, is encoded as it is.
    """

    _letters = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _ids(self, strings: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _words(self, plain: list[bytes]) -> dict[bytes, bytes]:
        """Ids of strings of letters, many at a time."""
        out: dict[bytes, bytes] = {}
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            ids = self._ids([b" ".join(some).decode()])[0]
            ends = (4 * (np.flatnonzero(self.last[np.frombuffer(ids, dtype="<u4")]) + 1)).tolist()
            if len(ends) == len(some):
                out.update((x, ids[start:end]) for x, start, end in zip(some, [0, *ends], ends))
            else:  # not one word each, as was expected
                out.update(zip(some, self._ids([x.decode() for x in some])))
        return out

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        """Ids of strings that are not known, and of the words in them."""
        plain, pointed, odd, known = set(), [], set(), self.known
        for x in new:
            word = x.rstrip(b".,;:!?")
            if not (word.isalpha() or self._letters.fullmatch(word.decode())):
                odd.add(x)
            elif len(word) == len(x):
                plain.add(x)
            else:
                points = x[len(word) :]
                pointed.append((x, word, points))
                if word not in known:
                    plain.add(word)
                if points not in known:
                    odd.add(points)
        out = self._words(list(plain))
        out.update(zip(odd, self._ids([x.decode() for x in odd])))
        of = lambda x: out[x] if x in out else known[x]
        out.update([(x, of(word) + of(points)) for x, word, points in pointed])
        return out

    def encode(self, batch: list) -> list[bytes]:
        data = [(t or "").encode() for t in batch]
        odd = [i for i, x in enumerate(data) if b"<|" in x]
        for i in odd:
            data[i] = b""
        words = [x.lower().split() for x in data]
        found = [list(map(self.known.get, w)) for w in words]
        gaps = [i for i, f in enumerate(found) if None in f]
        learnt = self._learn({x for i in gaps for x, v in zip(words[i], found[i]) if v is None})
        for i in gaps:
            found[i] = [learnt[x] if v is None else v for x, v in zip(words[i], found[i])]
        if len(self.known) < REMEMBERED:  # the common ones come first
            self.known.update(learnt)
        out = [b"".join(f) for f in found]
        for i in odd:
            out[i] = self._ids([batch[i]])[0]
        return out


def encoder(path: str) -> Encoder:
    """This process's encoder, which stays for the tasks that come to it later."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_starweave_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _slices(batch: list):
    """Texts in groups of about ``SLICE`` characters; a longer one is a group of its own."""
    at, size = 0, 0
    for i, t in enumerate(batch):
        if size and size + len(t or "") > SLICE:
            yield batch[at:i]
            at, size = i, 0
        size += len(t or "")
    yield batch[at:]


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of every row of ``docs``: doc_id, row, piece, start, length, ids_crc32 (and ids).

    A row's ids are its text's and the end id; null counts as the empty text, whose
    only id is the end id. Only what is longer than ``capacity`` is cut. ``row`` tells
    repeated rows and ids apart. ``ids`` are little-endian 32-bit numbers.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    fields = [T.StructField(n, T.LongType(), False) for n in ("piece", "start", "length", "ids_crc32")]
    fields += [T.StructField("ids", T.BinaryType(), False)] if with_ids else []
    schema = T.StructType([rows.schema["doc_id"], T.StructField("row", T.LongType(), False), *fields])

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        coder = encoder(path)
        for b in batches:
            ids = [x for part in _slices(texts(b)) for x in coder.encode(part)] if b.num_rows else []
            of, out = [], []
            for i, x in enumerate(ids):
                x += END_ID.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(x), 4 * capacity)):
                    part = x[at : at + 4 * capacity]
                    of.append(i)
                    out.append((piece, at // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            if out:
                own = [b.column(0).take(pa.array(of)), b.column(2).take(pa.array(of))]
                more = [pa.array(c, pa.binary() if n == 4 else pa.int64()) for n, c in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays(own + more, names=schema.names)

    return map_batches(rows, run, schema)


# ---------------------------------------------------------------- the linear program


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity``: the greatest price it holds, and the piece (its place; -1: none) taken last."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if k := fitting[room]:
            got = best[room - lengths[:k]] + prices[:k]
            j = int(got.argmax())
            if got[j] > best[room]:
                best[room], last[room] = got[j], j
    return best, last


def _contents(last: np.ndarray, lengths: np.ndarray, room: int) -> Counter:
    held: Counter = Counter()
    while room > 0:
        if (j := int(last[room])) < 0:
            room -= 1
        else:
            held[j] += 1
            room -= int(lengths[j])
    return held


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, float]:
    """Configurations (places of the lengths, pieces of each), the amount of each, and a lower bound on the sequences.

    The amounts are scaled so that all pieces are covered on average; rounding sees
    to each length. The bound is the dual one: the pieces' total price over the
    greatest price of a sequence. Prices begin as the lengths, whose bound is the
    number of tokens over the capacity.
    """
    prices, covered = lengths / capacity, np.zeros(len(lengths))
    columns: dict = {}
    bound = 0.0
    for _ in range(PASSES):
        best, last = knapsack(lengths, prices, capacity)
        bound = max(bound, float(counts @ prices) / best[capacity])
        value = prices + best[capacity - lengths]  # of the best configuration that holds this length
        # the lengths least covered name the columns, as far as their configuration is near the best
        near = np.flatnonzero(value >= (1 - NEAR) * best[capacity])
        for first in near[np.argsort(covered[near], kind="stable")][:COLUMNS]:
            held = _contents(last, lengths, capacity - int(lengths[first]))
            held[int(first)] += 1
            key = tuple(sorted(held.items()))
            at, n = np.array(key).T
            amount = STEP * float((counts[at] / n).min())
            columns[key] = columns.get(key, 0.0) + amount
            share = n * amount / counts[at]
            covered[at] += share
            prices[at] *= np.exp(-RATE * share)
    scale = float(counts @ lengths) / float((covered * counts) @ lengths)
    return [tuple(np.array(k).T) for k in columns], np.array(list(columns.values())) * scale, bound


def best_fit(histogram: dict[int, int], capacity: int, begun: list[tuple[dict[int, int], int]] = ()) -> list[tuple[dict[int, int], int]]:
    """Longest first, each piece into the fullest sequence that has room, ``begun`` ones too; equal sequences are filled together."""
    rooms: dict[int, list[tuple[dict[int, int], int]]] = {}
    open_rooms, out = 0, []  # bit r: there are sequences with room r

    def put(held: dict[int, int], room: int, times: int) -> None:
        nonlocal open_rooms
        if room:
            rooms.setdefault(room, []).append((held, times))
            open_rooms |= 1 << room
        else:
            out.append((held, times))

    for held, times in begun:
        put(held, capacity - sum(size * n for size, n in held.items()), times)
    for size in sorted((s for s in histogram if histogram[s]), reverse=True):
        n = histogram[size]
        while n:
            if fit := open_rooms >> size:
                room = size + (fit & -fit).bit_length() - 1
                held, times = rooms[room].pop()
                if not rooms[room]:
                    open_rooms &= ~(1 << room)
            else:
                held, room, times = {}, capacity, n
            each = min(room // size, n)  # the next piece, as long, finds this sequence the fullest still
            full = min(n // each, times)
            put(held | {size: held.get(size, 0) + each}, room - each * size, full)
            if times > full and held:
                put(held, room, times - full)
            n -= each * full
    return out + [x for groups in rooms.values() for x in groups]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(pieces of each length in a sequence, number of such sequences): all pieces of the histogram, in few sequences."""
    left = {size: n for size, n in histogram.items() if n}
    out: list[tuple[dict[int, int], int]] = []
    if left.get(capacity):
        out.append(({capacity: 1}, left.pop(capacity)))
    spare = {size: n // SPARE for size, n in left.items() if SPARE * size <= capacity}  # they fill what best fit would leave open
    left = {size: n - spare.get(size, 0) for size, n in left.items()}
    for _ in range(ROUNDS):
        lengths = np.array(sorted(left), dtype=np.int64)
        if not len(lengths):
            break
        counts = np.array([left[int(x)] for x in lengths], dtype=np.int64)
        columns, amounts, _ = solve(lengths, counts.astype(float), capacity)
        need, before = counts.copy(), int(counts.sum())
        for i in np.argsort(-amounts, kind="stable"):  # whole parts first, then one more of each that still fits
            at, n = columns[i]
            if whole := min(int(amounts[i]), int((need[at] // n).min())):
                need[at] -= whole * n
                out.append(({int(lengths[a]): int(k) for a, k in zip(at, n)}, whole))
        for i in np.argsort(np.floor(amounts) - amounts, kind="stable"):
            at, n = columns[i]
            if amounts[i] > 0.5 and (need[at] >= n).all():
                need[at] -= n
                out.append(({int(lengths[a]): int(k) for a, k in zip(at, n)}, 1))
        left = {int(x): int(n) for x, n in zip(lengths, need) if n}
        if need.sum() > before / 2:
            break
    return best_fit({size: left.get(size, 0) + spare.get(size, 0) for size in left | spare}, capacity, out)


# ---------------------------------------------------------------- placing the pieces


@dataclass(frozen=True)
class Places:
    """Where the pieces of each length go, by rank: rows sorted by (length, first rank)."""

    key: np.ndarray  # length << 48 | first rank
    sequence: np.ndarray  # first sequence
    each: np.ndarray  # pieces of the length in a sequence
    offset: np.ndarray  # place of the first of them

    @classmethod
    def of(cls, configurations: list[tuple[dict[int, int], int]]) -> Places:
        rows, next_rank, sequence = [], Counter(), 0
        for held, times in configurations:
            at = 0
            for size in sorted(held, reverse=True):
                rows.append((size << 48 | next_rank[size], sequence, held[size], at))
                next_rank[size] += held[size] * times
                at += size * held[size]
            sequence += times
        return cls(*np.array(sorted(rows), dtype=np.int64).reshape(-1, 4).T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        key = (length << 48) | rank
        row = np.searchsorted(self.key, key, "right") - 1
        nth = key - self.key[row]
        return self.sequence[row] + nth // self.each[row], self.offset[row] + nth % self.each[row] * length


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``pieces`` with their rank (from 0) among those of their length; ``counts``: the pieces of each length."""
    spark: SparkSession = pieces.sparkSession
    buckets = {size: -(-n // BUCKET_ROWS) for size, n in counts.items()}
    known = F.broadcast(spark.createDataFrame(sorted(buckets.items()), "length long, buckets long"))  # a row a length
    dealt = pieces.join(known, "length").withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.col("buckets"))).drop("buckets")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "bucket").count().select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row", "piece")) - 1
    sizes = F.broadcast(sizes) if sum(buckets.values()) <= BROADCAST_ROWS else sizes
    return dealt.withColumn("inside", inside).join(sizes, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("inside")).drop("bucket", "before", "inside")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (row, piece, length from 1 to ``capacity`` and any further columns) with sequence_id and offset.

    Pieces of one sequence follow each other without a gap. Equal lengths are told
    apart by (row, piece), which must be unique. No pieces, no sequences. The pieces
    are read twice, so they should be a written table.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    places = Places.of(plan(counts, capacity))
    fields = [T.StructField(n, T.LongType(), False) for n in ("sequence_id", "offset")]

    def find(batch: pa.RecordBatch) -> list:
        of = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy()
        return [pa.array(c, pa.int64()) for c in places.find(of("length"), of("rank"))]

    if not counts:
        return add_columns(pieces.withColumn("rank", F.lit(0).cast("long")), fields, find, keep=pieces.columns)
    return add_columns(ranked(pieces, counts), fields, find, keep=pieces.columns)


def query(docs: DataFrame, path: str | None = None) -> DataFrame:
    """op12: every document's pieces in sequences of at most 2048 tokens.

    Null, empty and very long texts, repeated rows and ids: see ``cut``. Further
    columns go; a table without rows gives no pieces.
    """
    pieces = save(cut(docs, path or tokenizer_path()), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
