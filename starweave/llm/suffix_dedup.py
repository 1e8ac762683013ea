"""Removal of repeated byte strings by fingerprints of suffixes sampled by content.

The rerank rounds of distributed prefix doubling were replaced: Spark groups the
sampled suffixes once, and prefixes are doubled inside the tasks.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too.

Ranking all positions in every round would shuffle many times the input, so the
suffixes that are ranked are sampled by content: a position is an anchor if the
hash of its ``GRAM`` bytes is the least among ``SPAN`` neighbouring positions.
Equal strings of LENGTH bytes hold an anchor at the same place, with at least
``PREFIX`` bytes behind it, so a string can only repeat if one of its anchors has
a prefix that repeats. Ranks are 64-bit fingerprints of what they stand for;
they need no renumbering and tell equal from unequal like numbers do.

Every start of LENGTH bytes belongs to one anchor, the least of the SPAN positions
from it on; equal strings have theirs at the same distance.

1. The anchors of every text are ranked by their first PREFIX bytes. Spark sorts
   the ranks; unique ones go. What repeats inside one batch of texts is known
   already, and only one row for it is sent, so that no common rank fills a task.
2. Each remaining anchor's surroundings are sorted by rank, so that whole rank
   classes meet. There, prefixes are doubled: the rank of twice the length is that
   of the pair (rank, rank at the offset), from single bytes until LENGTH is
   reached, for every start that belongs to the anchor. A start repeats if its
   rank occurs again in the class at the same distance from its anchor.
3. Classes of more than ``HOT`` anchors are never gathered: their starts are ranked
   where the texts are, a rank that repeats inside a text is settled there, and
   Spark counts one row per text and rank with partial sums.

Texts that are equal as a whole are ranked once: all bytes of such texts go if they
have LENGTH bytes. Texts are told apart by a 128-bit digest. Only texts with a
repeated anchor are shuffled.

`doubling_rounds` is the plain method, with a rank for every position and Spark's
rerank rounds; it shuffles many times the text and serves as a check.

Null texts are empty, and a null id is an id like any other. Repeated rows are texts
with copies and each have their result; an empty table has none. Columns beside
doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starweave.llm.common import BROADCAST_ROWS, save
from starweave.operators.bloom import bloom_filter, may_hold, size_for

LENGTH = 200
GRAM = 8
SPAN = 160
PREFIX = LENGTH - SPAN
HOT = 16_384
BATCH = 8_192  # anchors that are ranked at once, and whole classes beyond
_MASK = np.uint64((1 << 24) - 1)
_CHUNK = 1 << 22  # starts of a text that are scanned at once
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BYTE = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # rank of a single byte
_POWER = [pow(int(_A), 1 << i, 1 << 64) for i in range(64)]


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start) of a whole text: the starts of LENGTH bytes that belong to each anchor.

    A very long text is scanned in parts; an anchor whose starts lie in two parts comes twice.
    """
    last = len(data) - LENGTH  # the last start
    found = []
    for at in range(0, last + 1, _CHUNK):
        n = min(_CHUNK, last + 1 - at)
        part = np.frombuffer(data, dtype=np.uint8, count=n + SPAN + GRAM - 2, offset=at)
        h = np.lib.stride_tricks.sliding_window_view(part, GRAM).copy().view(np.uint64).ravel()
        h *= _A
        h ^= h >> np.uint64(29)
        h *= _B
        low = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width < SPAN:
            step = min(width, SPAN - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        pos = (low & _MASK).astype(np.int64)
        first = np.flatnonzero(np.append(True, pos[1:] != pos[:-1]))
        found.append((at + pos[first], at + first, at + np.append(first[1:], n) - 1))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def ranks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all starts by LENGTH bytes, and by the power of two below, by prefix doubling.

    The rank of a pair is rank * odd + rank at the offset, with an odd number for
    each length; equal strings have equal ranks wherever they are.
    """
    rank, width, step = _BYTE[data], 1, 0
    while 2 * width <= LENGTH:
        rank = rank[:-width] * np.uint64(_POWER[step]) + rank[width:]
        width, step = 2 * width, step + 1
    whole = rank[: -(LENGTH - width)] * _B + rank[LENGTH - width :] if width < LENGTH else rank.copy()
    whole ^= whole >> np.uint64(32)
    whole *= _A
    whole ^= whole >> np.uint64(29)
    return whole, rank


def repeated_starts(contexts: list[bytes], back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For anchors of one or more whole classes: number of the first and last repeated start of each, (1, 0) if none.

    A context reaches from the anchor's first start to LENGTH bytes behind its
    last; ``back`` is the distance from the first start to the anchor.
    """
    n = len(contexts)
    size = np.array([len(c) for c in contexts], dtype=np.int64)
    begin = np.cumsum(size) - size
    rank, half = ranks(np.frombuffer(b"".join(contexts), dtype=np.uint8))
    starts = size - LENGTH + 1
    row = np.repeat(np.arange(n), starts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(starts) - starts, starts)
    at = begin[row] + number
    # the distance to the anchor is part of the rank: starts belong to one anchor each
    value = rank[at] ^ ((back[row] - number).astype(np.uint64) * _A)
    order = np.argsort(value)
    value, spot = value[order], at[order]
    same = value[1:] == value[:-1]
    other = LENGTH - half_width()
    # what the last pair was made of must be equal as well
    same &= (half[spot[1:]] == half[spot[:-1]]) & (half[spot[1:] + other] == half[spot[:-1] + other])
    again = np.zeros(len(value), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    hit = np.zeros(len(value), dtype=bool)
    hit[order] = again
    row, number = row[hit], number[hit]
    first, last = np.full(n, 1), np.zeros(n, dtype=np.int64)
    if len(row):
        edge = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        first[row[edge]], last[row[edge]] = number[edge], number[np.append(edge[1:], len(row)) - 1]
    return first, last


def half_width() -> int:
    """The largest power of two up to LENGTH."""
    return 1 << (LENGTH.bit_length() - 1)


def _key():
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def _rank_anchors(docs: DataFrame) -> DataFrame:
    """(rank, key, pos, back, starts, known) of all anchors; known: the rank repeats within the batch."""

    def run(batches):
        for b in batches:
            rank, keys, cols, seen = [], [], [], set()
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k in seen:
                    continue
                seen.add(k)
                data = text.encode("utf-8", "surrogatepass")
                pos, first, last = anchors(data)
                rank.append(np.fromiter((xxhash.xxh64_intdigest(data[i : i + PREFIX]) for i in pos.tolist()), dtype=np.uint64, count=len(pos)))
                keys.append((k, len(pos)))
                cols.append((pos, (pos - first).astype(np.int32), (last - first + 1).astype(np.int32)))
            if not rank:
                continue
            rank = np.concatenate(rank).view(np.int64)
            key = pa.array([k for k, _ in keys], pa.binary()).take(pa.array(np.repeat(np.arange(len(keys)), [n for _, n in keys])))
            cols = [np.concatenate(c) for c in zip(*cols)]
            _, which, n = np.unique(rank, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(rank), key, *[pa.array(c) for c in (*cols, n[which] > 1)]], names=["rank", "key", "pos", "back", "starts", "known"])

    long = docs.where(F.octet_length("text") >= LENGTH).select(_key().alias("key"), "text")
    return save(long.mapInArrow(run, "rank long, key binary, pos long, back int, starts int, known boolean"), "anchors")


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(rank, key, pos, back, starts, hot) of the anchors whose first PREFIX bytes occur at another place too."""
    ranked = _rank_anchors(docs)
    names = ["rank", "key", "pos", "back", "starts"]
    known = ranked.where("known").select(*names)
    place = F.xxhash64("key", "pos")
    sent = ranked.where("not known").select(*names, place.alias("place"))
    # one row stands for all that a batch knows to repeat; it differs from every place
    sent = sent.union(known.select("rank").distinct().selectExpr("rank", "cast(null as binary)", "cast(null as long)", "0", "0", "-1L"))
    near = Window.partitionBy("rank")
    met = sent.withColumn("low", F.min("place").over(near)).withColumn("high", F.max("place").over(near)).where("low <> high and key is not null")
    found = save(known.union(met.select(*names)).distinct(), "repeated-anchors")
    common = save(found.groupBy("rank").count().where(F.col("count") > HOT).select("rank", F.lit(True).alias("hot")), "common-ranks")
    # one row for HOT anchors at least; broadcast so that a common rank's anchors stay where they are
    common = F.broadcast(common) if common.count() <= BROADCAST_ROWS else common
    return found.join(common, "rank", "left").select(*names, F.coalesce("hot", F.lit(False)).alias("hot"))


_ANCHOR, _START, _SPAN = 0, 1, 2


def _once(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text) once for each of ``keys`` (key; each once) that has a text; other texts are not shuffled.

    Up to ``BROADCAST_ROWS`` keys are broadcast; beyond that a Bloom filter drops most other texts.
    """
    keys = save(keys, "text-keys")
    n = keys.count()
    long = docs.where(F.octet_length("text") >= LENGTH).select(_key().alias("key"), "text")
    if n <= BROADCAST_ROWS:
        long = long.join(F.broadcast(keys), "key", "left_semi")
    elif (bits := size_for(n)) is not None:
        long = long.where(may_hold(bloom_filter(keys, ["key"], bits).scalar(), [F.col("key")], bits))
    return long.groupBy("key").agg(F.first("text").alias("text"))


def _surroundings(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of three kinds: anchors of small classes with the bytes around them (pos: first start; back), starts of
    common classes with their two ranks (one for each rank in a text), and spans that one text settles (pos, back: end)."""
    whole = _once(docs, found.select("key").distinct())
    places = found.groupBy("key").agg(F.collect_list(F.struct("pos", "rank", "back", "starts", "hot")).alias("places"))
    rows = whole.join(places, "key").select("key", "text", "places")
    shape = pa.schema([("kind", pa.int32()), ("rank", pa.int64()), ("rank2", pa.int64()), ("key", pa.binary()), ("pos", pa.int64()), ("back", pa.int64()), ("around", pa.binary())])

    def batch(kind, key, pos, rank=None, rank2=None, back=None, around=None):
        n = len(pos)
        cols = [np.full(n, kind, np.int32), rank, rank2, [key] * n, pos, back]
        cols = [pa.nulls(n, f.type) if c is None else pa.array(c, f.type) for c, f in zip(cols, shape)]
        return pa.RecordBatch.from_arrays([*cols, pa.nulls(n, pa.binary()) if around is None else pa.array(around, pa.binary())], schema=shape)

    def run(batches):
        for b in batches:
            for key, text, found in zip(*(b.column(i) for i in range(3))):
                data, key, spots = text.as_py().encode("utf-8", "surrogatepass"), key.as_py(), found.values
                pos, rank, back, starts, hot = (spots.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "rank", "back", "starts", "hot"))
                hot = hot.astype(bool)
                first = pos - back
                for i in range(0, int((~hot).sum()), BATCH):
                    p, n = first[~hot][i : i + BATCH], starts[~hot][i : i + BATCH]
                    around = [data[x : x + y + LENGTH - 1] for x, y in zip(p.tolist(), n.tolist())]
                    yield batch(_ANCHOR, key, p, rank[~hot][i : i + BATCH], None, back[~hot][i : i + BATCH], around)
                if hot.any():
                    p, one, two = _starts(data, first[hot], starts[hot])
                    _, at, which, n = np.unique(one, return_index=True, return_inverse=True, return_counts=True)
                    settled = union([(x, x + LENGTH) for x in p[n[which] > 1].tolist()])
                    if settled:
                        yield batch(_SPAN, key, [x for x, _ in settled], back=[y for _, y in settled])
                    for i in range(0, len(at), 1 << 16):
                        j = at[i : i + (1 << 16)]
                        yield batch(_START, key, p[j], one[j], two[j])

    return save(rows.mapInArrow(run, "kind int, rank long, rank2 long, key binary, pos long, back long, around binary"), "surroundings")


def _starts(data: bytes, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, two ranks) of all starts first, first + 1 ... of which each anchor has ``count``."""
    pos = np.sort(np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    one, two = [], []
    for at in range(0, len(data) - LENGTH + 1, 1 << 16):  # bounded memory for very long texts
        here = pos[np.searchsorted(pos, at) : np.searchsorted(pos, at + (1 << 16))] - at
        if len(here):
            part = np.frombuffer(data, dtype=np.uint8, count=min(len(data) - at, (1 << 16) + LENGTH), offset=at)
            rank, half = ranks(part)
            one.append(rank[here])
            two.append(half[here] * _B + half[here + LENGTH - half_width()])
    return pos, np.concatenate(one).view(np.int64), np.concatenate(two).view(np.int64)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, begin, end): stretches of text ``key`` that repeated strings of LENGTH bytes cover."""
    made = _surroundings(docs, repeated_anchors(docs))

    def classes(batches):
        held: list = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) <= BATCH:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            rank = t.column("rank").to_numpy()
            whole = int(np.searchsorted(rank, rank[-1], side="left"))  # the last class may go on
            if whole:
                yield from judged(t.slice(0, whole))
            held = t.slice(whole).to_batches()
        if held:
            yield from judged(pa.Table.from_batches(held))

    def judged(t):
        pos = t.column("pos").to_numpy()
        first, last = repeated_starts(t.column("around").to_pylist(), t.column("back").to_numpy())
        yes = first <= last
        yield pa.RecordBatch.from_arrays([t.column("key").combine_chunks().filter(pa.array(yes)), pa.array((pos + first)[yes]), pa.array((pos + last)[yes] + LENGTH)], names=["key", "begin", "end"])

    cold = made.where(F.col("kind") == _ANCHOR).select("rank", "key", "pos", "back", "around")
    spans = cold.repartition("rank").sortWithinPartitions("rank").mapInArrow(classes, "key binary, begin long, end long")
    settled = made.where(F.col("kind") == _SPAN).select("key", F.col("pos").alias("begin"), F.col("back").alias("end"))
    # common classes: a rank of two different texts
    hot = made.where(F.col("kind") == _START).select("rank", "rank2", "key", "pos")
    again = hot.groupBy("rank", "rank2").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("rank", "rank2")
    common = hot.join(again, ["rank", "rank2"]).select("key", F.col("pos").alias("begin"), (F.col("pos") + LENGTH).alias("end"))
    return spans.union(settled).union(common)


def doubling_rounds(docs: DataFrame, first: int = 25) -> DataFrame:
    """(row, pos): the starts of repeated strings of LENGTH bytes, by a rank of every position and Spark's rounds.

    ``docs``: row (unique) and text. The first ranks stand for ``first`` bytes. A
    round drops the positions whose rank is unique, and ranks the rest anew by the
    pair (rank, rank at the offset), until LENGTH is reached: a string can only
    repeat if both of its parts do.
    """

    def begin(batches):
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                for at in range(0, len(data) - first + 1, _CHUNK):
                    n = min(_CHUNK, len(data) - first + 1 - at)
                    part = data[at : at + n + first - 1]
                    rank = np.fromiter((xxhash.xxh64_intdigest(part[i : i + first]) for i in range(n)), dtype=np.uint64, count=n)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row)), pa.array(np.arange(at, at + n)), pa.array(rank.view(np.int64))], names=["row", "pos", "rank"])

    def repeated(ranks):
        again = ranks.groupBy("rank").count().where("count > 1").select("rank")
        return save(ranks.join(again, "rank", "left_semi"), "rounds")

    ranks = docs.where(F.octet_length("text") >= LENGTH).select("row", "text").mapInArrow(begin, "row long, pos long, rank long")
    left, width = repeated(save(ranks, "rounds")), first
    while width < LENGTH:
        offset = min(width, LENGTH - width)
        ahead = left.select("row", (F.col("pos") - offset).alias("pos"), F.col("rank").alias("ahead"))
        left = repeated(left.join(ahead, ["row", "pos"]).select("row", "pos", F.xxhash64("rank", "ahead").alias("rank")))
        width += offset
    return left.select("row", "pos")


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint maximal stretches, in order."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for s, e in spans:
        out.append(data[at:s])
        at = e
    return b"".join([*out, data[at:]])


def merged(spans: DataFrame) -> DataFrame:
    """(key, spans): the disjoint maximal stretches of each text, as an array of (begin, end) in order."""
    each = F.array_sort(F.collect_set(F.struct("begin", "end")))
    return spans.groupBy("key").agg(each.alias("spans"))


def query(docs: DataFrame) -> DataFrame:
    """op10: one row for each row of ``docs``. Null texts are empty; texts under 200 bytes lose nothing."""
    docs = docs.select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    rows = save(docs.select("doc_id", _key().alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest")), "texts")
    copies = rows.where(F.col("n_bytes") >= LENGTH).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    spans = save(merged(repeated_spans(docs)), "repeated-spans")

    def cut(batches):
        for b in batches:
            out = []
            for t, found in zip(b.column(1), b.column(2)):
                data = t.as_py().encode("utf-8", "surrogatepass")
                stretches = union([(s["begin"], s["end"]) for s in found.as_py()])
                out.append((sum(e - s for s, e in stretches), len(stretches), hashlib.sha256(kept(data, stretches)).hexdigest()))
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["key", "removed", "parts", "rest"])

    # texts with copies go whole and need no cutting
    partial = spans.join(copies, "key", "left_anti")
    cutting = docs.where(F.octet_length("text") >= LENGTH).select(_key().alias("key"), "text").join(partial, "key").select("key", "text", "spans")
    done = cutting.mapInArrow(cut, "key binary, removed long, parts long, rest string").dropDuplicates(["key"])
    out = rows.join(copies, "key", "left").join(done, "key", "left")
    whole = F.col("n").isNotNull()
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("parts", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("rest", "digest")).alias("kept_sha256"),
    )
