"""Exact top-k inner-product search by no-random-access aggregation.

The candidates are cut into blocks; in a block every dimension is a list of its
vectors sorted by component. For a query, a list is read from the end that gives
the largest products. Lists are read in step, to growing depth. A vector's upper
bound counts what was read of it, plus for every list where it hasn't appeared the
last product read there; its lower bound takes the list's smallest product
instead. Reading stops when the k-th best lower bound, or the k-th best score
that the query has from blocks before, is above the upper bound of all but a few
vectors; the final scores of those are then resolved. The first block gives every
query the score that all later ones have to reach. Queries come in blocks too, and
the block pairs are dealt as cells of a grid: a few query blocks against a few
vector blocks, which meet in one task. A cell holds at most ``CELL`` blocks of
either side and the scores of its own queries only; the number of cells grows with
the counted work. Only what can be among the k best leaves a cell, and no pair of
single vectors is ever shuffled.

Null ids, null vectors and vectors with null or non-finite parts take no part;
vectors of another length than the query's are no candidates. Ties go to the
smaller vec_id. Empty tables have an empty result, and columns beside vec_id and
embedding are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starweave.llm.common import save

K = 5
SCALE = 256
BLOCK, QUERIES = 2048, 512  # vectors and queries in a block
CELL = 32  # most blocks of either side in a cell, of vectors up to WIDE numbers; fewer of longer ones
WIDE = 64
MIN_CELLS = 64  # small tables are cut into more, smaller cells
MOST_PARTS = 1 << 15  # most shuffle partitions the cells are dealt over
SEEDS = 32  # most blocks that are broadcast
GRID = 32  # depths that are looked at before a list is read


def sorted_lists(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two lists for each dimension, ascending (number d) and descending (number dims + d): positions, and components."""
    up = np.argsort(values, axis=0, kind="stable").T
    at = np.concatenate([up, up[:, ::-1]])
    dims = values.shape[1]
    return at, values[at, np.tile(np.arange(dims), 2)[:, None]].astype(np.float64)


def nra(query: np.ndarray, lists: tuple[np.ndarray, np.ndarray], n: int, k: int, floor: float) -> np.ndarray:
    """Positions among ``n`` vectors that may be among the k best or reach ``floor``; all that do are there.

    ``lists``: see ``sorted_lists``. Sums are exact in doubles below 2**53, so
    bounds never rule out an equal score.
    """
    dims = np.flatnonzero(query)
    if n <= k or not len(dims):
        return np.arange(n)
    q = query[dims].astype(np.float64)[:, None]
    which = dims + len(query) * (q[:, 0] > 0)  # the end with the largest products comes first
    low = q * lists[1][which, -1:]
    known = floor > -np.inf
    depth = max(k, n // 2)  # without a floor, bounds only meet far down
    if known:
        # a vector that no list has shown yet is out once the last products add up to less than the floor
        grid = np.unique(np.linspace(0, n - 1, GRID).astype(np.int64))
        unseen = (q * lists[1][which[:, None], grid]).sum(axis=0)
        out = grid[unseen < floor]
        depth = int(1.5 * out[0]) + k if len(out) else n  # and half as far again for those that some lists have shown
    while True:
        depth = min(depth, n)
        at = lists[0][which, :depth].ravel()
        product = q * lists[1][which, :depth]
        last = product[:, -1:]
        upper = last.sum() + np.bincount(at, (product - last).ravel(), n)
        if not known:
            lower = low.sum() + np.bincount(at, (product - low).ravel(), n)
            floor = max(floor, np.partition(lower, n - k)[n - k])
        left = np.flatnonzero(upper >= floor)
        if depth == n or len(left) <= max(8 * k, n // 4):
            return left
        depth = depth * 5 // 4 + 1


def best(queries: np.ndarray, query_ids: np.ndarray, values: np.ndarray, ids: np.ndarray, lists: tuple, k: int, floors: np.ndarray, kept: dict) -> list[tuple]:
    """The block's k best for each query, without the query's own id: (number of the query, vec_id, score).

    ``lists``: the block's. ``kept`` holds each query's k best scores of this
    cell so far, ``floors`` the k-th of them.
    """
    out = []
    for i, (query, own) in enumerate(zip(queries, query_ids)):
        # the query itself (and copies under its id) may be among the best: read for that many more
        extra = int((ids == own).sum())
        at = nra(query, lists, len(values), k + extra, floors[i])
        at = at[ids[at] != own]
        score = values[at] @ query
        first = np.lexsort((ids[at], -score))[:k]
        out += [(i, v, s) for v, s in zip(ids[at][first], score[first])]
        if len(first):
            top = np.sort(np.concatenate([kept.get(i, np.zeros(0, np.int64)), score[first]]))[-k:]
            kept[i] = top
            if len(top) == k:
                floors[i] = max(floors[i], top[0])
    return out


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x); null ids, null vectors and vectors with null or non-finite parts go."""
    fine = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    return rows.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def _blocks(rows: DataFrame, size: int, count: int) -> DataFrame:
    """One row per block: dims, block, ids and values (binary, 8 bytes each); blocks hold about ``size`` rows."""
    parts = max(1, -(-count // size))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        v = table.column("v").combine_chunks()
        return pa.table({
            "dims": pa.array([table.column("dims")[0].as_py()], pa.int32()), "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
            "ids": [table.column("vec_id").to_numpy().astype(np.int64).tobytes()], "vals": [v.flatten().to_numpy().astype(np.int64).tobytes()],
        })

    return rows.groupBy("dims", "block").applyInArrow(pack, "dims int, block int, ids binary, vals binary")


def _matrix(dims: int, ids: bytes, vals: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return np.frombuffer(vals, np.int64).reshape(len(ids), dims), ids


def grid(blocks: int, asks: int, dims: int) -> tuple[int, int]:
    """(groups of query blocks, slots of vector blocks): the cells of so many blocks of vectors of ``dims`` numbers."""
    most = max(1, min(CELL, CELL * WIDE // max(1, dims)))
    groups = max(1, -(-asks // most))
    return groups, max(1, min(blocks, max(-(-blocks // most), -(-MIN_CELLS // groups))))


def search(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its k best of ``candidates`` (both: vec_id, v, dims, row).

    Vectors of another length than the query's are no candidates.
    """
    (n, dims), nq = candidates.agg(F.count("*"), F.coalesce(F.max("dims"), F.lit(0))).first(), queries.count()
    packed = save(_blocks(candidates, BLOCK, n), "vectors").withColumnsRenamed({"ids": "cand_ids", "vals": "cand_vals"})
    asked = save(_blocks(queries, QUERIES, nq), "queries").withColumnRenamed("block", "ask")

    # first, every query against one block, whose k-th best score all other blocks have to reach
    seed = packed.join(packed.groupBy("dims").agg(F.min("block").alias("block")), ["dims", "block"], "left_semi").select("dims", "cand_ids", "cand_vals")
    seed = F.broadcast(seed) if seed.count() <= SEEDS else seed  # one block of bounded size for each length of vectors

    def begin(batches):
        for b in batches:
            for dims, ask, ids, vals, cand_ids, cand_vals in zip(*(c.to_pylist() for c in b.columns)):
                floors = np.full(len(ids) // 8, -np.inf)
                values, own = _matrix(dims, cand_ids, cand_vals)
                best(*_matrix(dims, ids, vals), values, own, sorted_lists(values), k, floors, {})
                yield pa.RecordBatch.from_pylist([{"dims": dims, "ask": ask, "floors": floors.tobytes()}], schema=pa.schema([("dims", pa.int32()), ("ask", pa.int32()), ("floors", pa.binary())]))

    floors = asked.join(seed, "dims").select("dims", "ask", "ids", "vals", "cand_ids", "cand_vals").mapInArrow(begin, "dims int, ask int, floors binary")
    asked = asked.join(save(floors, "floors"), ["dims", "ask"])

    groups, slots = grid(-(-n // BLOCK), -(-nq // QUERIES), dims)
    parts = min(MOST_PARTS, 2 * groups * slots)
    cell = ["dims", "group", "slot"]
    asked = asked.withColumn("group", F.pmod("ask", F.lit(groups))).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    packed = packed.withColumn("slot", F.pmod("block", F.lit(slots))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked, packed = (x.repartition(parts, *cell) for x in (asked, packed))  # a given number: cells are small, but much work

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        state = [(*_matrix(q["dims"], q["ids"], q["vals"]), np.frombuffer(q["floors"]).copy(), {}, []) for q in left.select(["dims", "ids", "vals", "floors"]).to_pylist()]
        for i in range(right.num_rows if state else 0):
            values, ids = _matrix(*(right.column(c)[i].as_py() for c in ("dims", "cand_ids", "cand_vals")))
            lists = sorted_lists(values)
            for query, own, floors, kept, found in state:
                found.append(np.array(best(query, own, values, ids, lists, k, floors, kept), dtype=np.int64).reshape(-1, 3))
        rows = [np.zeros((0, 3), np.int64)]
        for _, own, floors, _, found in state:
            got = np.concatenate([rows[0], *found])
            got = got[got[:, 2] >= floors[got[:, 0]]]  # by now the k-th best of the cell, or of the first block
            got[:, 0] = own[got[:, 0]]
            rows.append(got)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(c) for c in np.concatenate(rows).T.copy()))))

    found = asked.groupBy(*cell).cogroup(packed.groupBy(*cell)).applyInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(embeddings: DataFrame, every: int = 50) -> DataFrame:
    """op2: the 5 best of every vector whose id is divisible by ``every``.

    A repeated query id is one query for each of its different vectors' rows,
    merged under the id; a repeated candidate id counts once for each row.
    """
    rows = integers(embeddings).withColumn("dims", F.size("v"))
    rows = save(rows.withColumn("row", F.monotonically_increasing_id()), "integers")
    return search(rows.where(F.col("vec_id") % every == 0), rows)
