"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: 64 bits from the XXH64 hashes of all 3-word shingles. Links: at
most ``MAX_BITS`` differing bits, among the distinct fingerprints.

Search. A code is cut into parts, four of 16 bits for up to ``FEW`` codes and five
beyond; of two codes within 3 bits, all parts but three agree at least. For each
choice of as many parts, those are brought to the top of the code, and the codes
are sorted by Gray rank over the cluster (range exchange) and cut
into blocks of at most ``BLOCK`` codes, so no key, however common, makes a
block larger. Every block holds a hierarchy: neighbours in Gray order share most
of their bits, and the bits on which all members of a group agree (mask and
pattern) are kept once, in the group's node, the children keeping only what is
left. A query walks down from the root, adds up the differing bits of the masked
patterns and drops a whole group as soon as the sum is over the limit. Codes with
the same top parts lie in one block, or in a run of blocks; for such runs, the
pairs of blocks whose root patterns differ in at most 3 bits are searched too.
Links inside a block are merged at once, each code then gets one link to the
first of its group, so the output stays linear; `connected` joins the rest.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.llm.common import BROADCAST_ROWS, add_columns, connected, map_batches, save, texts, without

MAX_BITS = 3
SHINGLE = 3
BLOCK = 4096
FAN = 8
QUERIES = 64  # codes that walk the index at once; where a block is one group, each meets all its codes
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
FEW = BLOCK << 16  # codes up to which equal top parts of 16 bits fit one block on average


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash as an unsigned number; texts without words: 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    total, n = np.zeros(64, dtype=np.int64), len(words) - size + 1
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = words[i : i + (1 << 16) + size - 1]
        grams = map(b" ".join, zip(*(part[j:] for j in range(size))))
        h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype=np.uint64, count=len(part) - size + 1)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, name: str = "code", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the fingerprint as a signed bigint (same 64 bits)."""

    def run(b):
        return [pa.array(np.array([fingerprint(t) for t in texts(b, text)], dtype=np.uint64).view(np.int64), pa.int64())]

    return add_columns(docs, [T.StructField(name, T.LongType())], run, keep)


def gray_rank(code: Column) -> Column:
    """Position of a code in Gray order (bits, to be read as unsigned)."""
    for s in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, s))
    return code


def layouts(parts: int) -> list[list[tuple[int, int, int]]]:
    """For each choice of all parts but three: (old place, new place, bits) of every part, the chosen ones on top.

    Places count from the lowest bit; the chosen parts come first in each list.
    """
    width = [64 // parts + (i < 64 % parts) for i in range(parts)]
    low = [sum(width[:i]) for i in range(parts)]
    out = []
    for chosen in combinations(range(parts), parts - MAX_BITS):
        at, layout = 64, []
        for i in [*chosen, *(j for j in range(parts) if j not in chosen)]:
            at -= width[i]
            layout.append((low[i], at, width[i]))
        out.append(layout)
    return out


def arranged(code: Column, layout: list[tuple[int, int, int]]) -> Column:
    out = F.lit(0).cast("bigint")
    for old, new, bits in layout:
        part = F.shiftrightunsigned(code, old).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
        out = out.bitwiseOR(F.shiftleft(part, new))
    return out


def build(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from root to leaves: (bits a node adds to its ancestors' mask, pattern)."""
    mask, pattern = np.full(len(codes), _ALL), codes
    levels = [(mask, pattern)]
    while len(pattern) > 1:
        at = np.arange(0, len(pattern), FAN)
        all_ones, any_ones = np.bitwise_and.reduceat(pattern, at), np.bitwise_or.reduceat(pattern, at)
        above = np.bitwise_and.reduceat(mask, at) & ~(all_ones ^ any_ones)
        up = np.repeat(above, FAN)[: len(pattern)]
        levels[-1] = (levels[-1][0] & ~up, levels[-1][1])
        mask, pattern = above, all_ones & above
        levels.append((mask, pattern))
    return levels[::-1]


def search(queries: np.ndarray, levels: list, top: np.uint64, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) numbers of codes that agree in the bits of ``top`` and differ in at most ``max_bits`` bits."""
    q = np.arange(len(queries))
    node = np.zeros(len(queries), dtype=np.int64)
    acc = np.zeros(len(queries), dtype=np.int64)
    for depth, (extra, pattern) in enumerate(levels):
        if depth:
            node = (node[:, None] * FAN + np.arange(FAN)).ravel()
            q, acc = np.repeat(q, FAN), np.repeat(acc, FAN)
            inside = node < len(pattern)
            q, node, acc = q[inside], node[inside], acc[inside]
        x = (queries[q] ^ pattern[node]) & extra[node]
        acc = acc + np.bitwise_count(x)
        near = (acc <= max_bits) & ((x & top) == 0)
        q, node, acc = q[near], node[near], acc[near]
    return q, node


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest label of each group after the links a-b."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return label
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            nearer = label[label]
            if (nearer == label).all():
                break
            label = nearer


def _stars(nodes: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(label != np.arange(len(label)))
    return nodes[at], nodes[label[at]]


def top_mask(bits: int) -> np.uint64:
    return _ALL << np.uint64(64 - bits)


def links_inside(codes: np.ndarray, nodes: np.ndarray, top: np.uint64, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    levels, label = build(codes), np.arange(len(codes))
    for i in range(0, len(codes), QUERIES):
        q, leaf = search(codes[i : i + QUERIES], levels, top, max_bits)
        q = q + i
        label = merge(label, q[leaf > q], leaf[leaf > q])
    return _stars(nodes, label)


def links_between(a: np.ndarray, a_nodes: np.ndarray, b: np.ndarray, b_nodes: np.ndarray, top: np.uint64, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    levels, label = build(b), np.arange(len(a) + len(b))
    for i in range(0, len(a), QUERIES):
        q, leaf = search(a[i : i + QUERIES], levels, top, max_bits)
        label = merge(label, q + i, leaf + len(a))
    return _stars(np.concatenate([a_nodes, b_nodes]), label)


def _edge_batch(found) -> pa.RecordBatch:
    u = np.concatenate([np.zeros(0, np.int64)] + [x for x, _ in found])
    v = np.concatenate([np.zeros(0, np.int64)] + [y for _, y in found])
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _codes(value) -> np.ndarray:
    return np.frombuffer(value.as_py(), dtype=np.uint64)


def _nodes(value) -> np.ndarray:
    return np.frombuffer(value.as_py(), dtype=np.int64)


def blocks(points: DataFrame, parts: int) -> DataFrame:
    """``points`` (code, node: unique codes) as blocks in Gray order, for each layout of ``parts`` parts.

    Columns: id, turn (number of the layout), bits (of its top parts), first and
    last (top parts of the rank, of the block's ends), mask and pattern of the
    root, codes, nodes (binary, 8 bytes each).
    """
    plans = layouts(parts)
    bits = [sum(w for _, _, w in x[: parts - MAX_BITS]) for x in plans]
    turns = F.explode(F.array(*[F.struct(F.lit(r).alias("turn"), arranged(F.col("code"), x).alias("code")) for r, x in enumerate(plans)]))
    spread = points.select("node", turns.alias("p")).select("node", "p.turn", "p.code")
    # xor with the sign bit makes the signed order that of the unsigned ranks
    ranked = spread.withColumn("rank", gray_rank(F.col("code")).bitwiseXOR(F.lit(-(1 << 63))))
    sorted_ = ranked.repartitionByRange("turn", "rank").sortWithinPartitions("turn", "rank").select("node", "turn", "code", "rank")

    def row(turn, code, node, rank):
        every, some = np.bitwise_and.reduce(code), np.bitwise_or.reduce(code)
        mask = ~(every ^ some)
        top = (rank[[0, -1]].view(np.uint64) >> np.uint64(64 - bits[turn])).astype(np.int64)
        return {"turn": int(turn), "bits": bits[turn], "first": int(top[0]), "last": int(top[1]), "mask": int(mask.view(np.int64)), "pattern": int((every & mask).view(np.int64)), "codes": code.tobytes(), "nodes": node.tobytes()}

    def cut(batches):
        held = None
        for b in batches:
            new = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            out = []
            while len(held[0]) > BLOCK or (len(held[0]) and held[1][0] != held[1][-1]):
                n = min(BLOCK, int(np.searchsorted(held[1], held[1][0], side="right")))
                if n == len(held[0]):
                    break
                node, turn, code, rank = (x[:n] for x in held)
                out.append(row(turn[0], code.view(np.uint64), node, rank))
                held = [x[n:] for x in held]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if held is not None and len(held[0]):
            node, turn, code, rank = held
            yield pa.RecordBatch.from_pylist([row(turn[0], np.ascontiguousarray(code).view(np.uint64), node, rank)], schema=arrow)

    arrow = pa.schema([("turn", pa.int32()), ("bits", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("mask", pa.int64()), ("pattern", pa.int64()), ("codes", pa.binary()), ("nodes", pa.binary())])
    made = map_batches(sorted_, cut, "turn int, bits int, first long, last long, mask long, pattern long, codes binary, nodes binary")
    return save(made.withColumn("id", F.monotonically_increasing_id()), "simhash-blocks")


def near_pairs(points: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """(u, v): links between nodes whose components are those of all pairs within ``max_bits`` (at most 3) bits.

    ``parts`` (4 or more; default: by the number of codes) sets how finely the
    search is spread; the components are the same.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the parts find pairs within {MAX_BITS} bits at most")
    made = blocks(points, parts or (MAX_BITS + 1 if points.count() <= FEW else MAX_BITS + 2))

    def inside(batches):
        for b in batches:
            yield _edge_batch([links_inside(_codes(c), _nodes(n), top_mask(t.as_py()), max_bits) for c, n, t in zip(*b.columns)])

    def between(batches):
        for b in batches:
            yield _edge_batch([links_between(_codes(a), _nodes(x), _codes(c), _nodes(y), top_mask(t.as_py()), max_bits) for a, x, c, y, t in zip(*b.columns)])

    # blocks that begin or end within the same top parts: the pairs are found on numbers, masks and patterns, which are
    # small, and dealt evenly before their codes are fetched, so that one long run is not the work of one task
    ends = made.select("turn", "bits", "id", "mask", "pattern", "first", "last").withColumn("chunk", F.explode(F.array_distinct(F.array("first", "last"))))
    a, b = ends.alias("a"), ends.alias("b")
    differ = F.bit_count(F.col("a.pattern").bitwiseXOR(F.col("b.pattern")).bitwiseAND(F.col("a.mask")).bitwiseAND(F.col("b.mask")))
    runs = a.join(b, (F.col("a.turn") == F.col("b.turn")) & (F.col("a.chunk") == F.col("b.chunk")) & (F.col("a.id") < F.col("b.id")) & (differ <= max_bits))
    met = save(runs.select(F.col("a.id").alias("id"), F.col("b.id").alias("id_b")).distinct(), "simhash-block-pairs")
    one = made.select("id", "codes", "nodes", "bits")
    other = made.select(F.col("id").alias("id_b"), F.col("codes").alias("codes_b"), F.col("nodes").alias("nodes_b"))
    pairs = met.join(one, "id").join(other, "id_b").select("codes", "nodes", "codes_b", "nodes_b", "bits")
    out = map_batches(made.select("codes", "nodes", "bits"), inside, "u long, v long")
    return out.union(map_batches(pairs, between, "u long, v long"))


def components(codes: DataFrame) -> DataFrame:
    """(code, component) for every distinct code of ``codes`` (doc_id, code).

    component: the smallest non-null doc_id reachable over links, rows without an id
    link like any other (null if no row of the group has an id). Texts are not linked
    by sharing an id.
    """
    points = save(codes.groupBy("code").agg(F.min("doc_id").alias("node")), "simhash-codes")
    if points.groupBy("node").count().where("node is null or count > 1").isEmpty():
        groups = connected(near_pairs(points), "simhash-links")
        return points.join(groups, "node", "left").select("code", F.coalesce("component", "node").alias("component"))
    # a missing id, or one with several texts, is no node: the codes are, and each group is named afterwards
    groups = connected(near_pairs(points.select("code", F.col("code").alias("node"))), "simhash-links")
    named = points.join(groups, points["code"] == groups["node"], "left").select("code", F.coalesce("component", "code").alias("first"), points["node"])
    named = save(named, "simhash-groups")
    least = named.groupBy("first").agg(F.min("node").alias("component"), F.count("*").alias("n"))
    # codes alone in their group are named by it; the others' names are broadcast if few, so that a large group stays spread
    names = save(least.where("n > 1").select("first", "component"), "simhash-names")
    names = F.broadcast(names) if names.count() <= BROADCAST_ROWS else names
    return named.join(names, "first", "left").select("code", F.coalesce("component", "node").alias("component"))


def query(docs: DataFrame) -> DataFrame:
    """op8: doc_id, fingerprint, component_id for every row; repeated rows each get a row.

    Null and empty texts have fingerprint zero and link like any other; very long texts
    are taken whole, part by part; further columns go; a table without rows gives none.
    """
    codes = save(with_fingerprints(docs.select("doc_id", "text"), keep=["doc_id"]), "simhash")
    return codes.join(components(codes), "code", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the document with the smallest id of each component stays.

    Rows without an id are kept; rows that repeat the id and text of a document
    that stays are that document and stay. An id with several texts is a
    document for each of them.
    """
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    codes = save(with_fingerprints(keyed, keep=["doc_id", "key"]), "simhash")
    groups = components(codes)
    gone = codes.join(groups, "code").where("doc_id <> component").select(F.col("doc_id").alias("gone"), F.col("key").alias("gone_key")).distinct()
    return without(docs, gone, "gone", "gone_key")
