"""Packing into optimal length buckets.

A global histogram of token counts, one aggregation over all documents, feeds a
dynamic programme that places the bucket boundaries so that padding (boundary
minus length, over all documents) is least. Lengths up to 2 * ``STEPS`` are kept
apart; longer ones share a bin with those within one part in ``STEPS``, so the
histogram stays a few thousand rows whatever the corpus, and the padding is less
than one part in ``STEPS`` of the padded size above the least. Inside a bucket,
batches of as many documents as the token budget allows are filled in hash
shards of bounded size, so no bucket is one task; only the last batch of a shard
may be short. A document longer than the budget makes a batch of its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starweave.llm.common import save

BUCKETS = 12
BUDGET = 65_536
STEPS = 256
SHARD_ROWS = 50_000
_WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def histogram(lengths: DataFrame, col: str = "n_tokens") -> list[tuple[int, int, int]]:
    """(largest length, rows, total length) of each bin, ascending."""
    n = F.col(col)
    step = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))) - int(np.log2(STEPS))))
    rows = lengths.groupBy(F.ceil(n / step).alias("part"), step.alias("step")).agg(F.max(n), F.count("*"), F.sum(n))
    return sorted(tuple(r)[2:] for r in rows.collect())


def boundaries(bins: list[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper ends (lengths, ascending) of at most ``buckets`` buckets with the least total padding."""
    if not bins:
        return []
    top = np.array([b[0] for b in bins], dtype=np.float64)
    c = np.concatenate([[0.0], np.cumsum([b[1] for b in bins], dtype=np.float64)])
    s = np.concatenate([[0.0], np.cumsum([b[2] for b in bins], dtype=np.float64)])
    n, k = len(bins), min(buckets, len(bins))
    best = top * c[1:] - s[1:]  # one bucket over bins 0..j
    back = np.zeros((k, n), dtype=np.int64)
    for row in range(1, k):
        new = np.full(n, np.inf)
        for j in range(row, n):
            first = np.arange(row, j + 1)  # first bin of the last bucket
            cost = best[first - 1] + top[j] * (c[j + 1] - c[first]) - (s[j + 1] - s[first])
            i = int(cost.argmin())
            new[j], back[row, j] = cost[i], first[i]
        best = new
    out, j = [], n - 1
    for row in range(k - 1, -1, -1):
        out.append(int(top[j]))
        j = int(back[row, j]) - 1
    return out[::-1]


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_tokens, bucket, bucket_len, padding, shard, batch, slot.

    (bucket, shard, batch) names a batch. Null and empty texts have 0 tokens and
    lie in the first bucket; equal lengths and repeated rows are told apart by
    their place in the written lengths, and each gets a slot. Without rows there
    are no batches.
    """
    rows = save(docs.select(F.col(doc_id).alias("doc_id"), token_count(F.col(text)).alias("n_tokens")).withColumn("row", F.monotonically_increasing_id()), "packing")
    bins = histogram(rows)
    ends = boundaries(bins, buckets)
    bucket, length, per_batch, shards = F.lit(0), F.lit(0), F.lit(1), F.lit(1)
    low = -1
    for i, end in enumerate(ends):
        held = sum(n for top, n, _ in bins if low < top <= end)
        inside = F.col("n_tokens") > low
        bucket, length = F.when(inside, i).otherwise(bucket), F.when(inside, F.lit(end)).otherwise(length)
        per_batch = F.when(inside, F.lit(max(1, budget // max(1, end)))).otherwise(per_batch)
        shards = F.when(inside, F.lit(-(-held // SHARD_ROWS))).otherwise(shards)
        low = end
    spread = rows.select("*", bucket.alias("bucket"), length.cast("long").alias("bucket_len"), per_batch.alias("per_batch"), F.pmod(F.xxhash64("row"), shards).alias("shard"))
    place = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("doc_id", "row")) - 1
    spread = spread.withColumn("place", place.cast("long"))
    return spread.select(
        "doc_id", "n_tokens", "bucket", "bucket_len", (F.col("bucket_len") - F.col("n_tokens")).alias("padding"), "shard",
        F.floor(F.col("place") / F.col("per_batch")).alias("batch"), (F.col("place") % F.col("per_batch")).alias("slot"),
    )


def query(docs: DataFrame) -> DataFrame:
    """op3: every document's place in the batches."""
    return pack(docs.select("doc_id", "text"))


def pack_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the batches of all documents that are left."""
    return pack(docs.select("doc_id", "text"))
