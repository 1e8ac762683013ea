"""Helpers shared by the operators: tables, saved steps, per-batch columns, connected groups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweave.operators.bloom import bloom_filter, may_hold, size_for
from starweave.session import shared_path


BROADCAST_ROWS = 200_000  # most rows, of a few short columns, that are broadcast
BATCH_ROWS = 1000  # of a batch that goes to Python and back


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows reads files, so a lost executor costs its own tasks only, and
    a result that several later steps use is computed once.
    """
    path = shared_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` in batches of at most ``BATCH_ROWS`` rows, unless the session sets a size of its own.

    With Spark's default of 10,000 rows a batch of texts is some tens of MB, which both the
    JVM, outside its heap, and the Python worker hold several times for every task.
    """
    key, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if df.sparkSession.conf.get(key, default) == default:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def add_columns(
    df: DataFrame,
    fields: Sequence[T.StructField],
    fn: Callable[[pa.RecordBatch], list],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns computed by ``fn`` from whole Arrow batches, behind the columns named in ``keep`` (default: all)."""
    keep = df.columns if keep is None else list(keep)
    at = [df.columns.index(c) for c in keep]
    schema = T.StructType([df.schema[i] for i in at] + list(fields))
    names = schema.names

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(i) for i in at] + list(fn(b)), names=names)

    return map_batches(df, run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def pieces(text: str, size: int = 1 << 20):
    """The whole text in parts of at most ``size`` characters, cut behind white space where there is any."""
    at = 0
    while len(text) - at > size:
        end = max(text.rfind(" ", at, at + size), text.rfind("\n", at, at + size)) + 1
        end = end if end > at else at + size
        yield text[at:end]
        at = end
    yield text[at:]


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(divisor)


def bounded_sample(rows: DataFrame, group: str, ids: Sequence[str], size: int) -> DataFrame:
    """(group, *ids): at most ``size`` different ids of each group, those with the smallest hash.

    The groups' counts of different ids first give a cut by hash that leaves
    about four times as many ids as are wanted, so that no task ranks more than
    that of a group. The counts are estimates, within a few hundredths.
    """
    rows = rows.select(group, *ids)
    counts = save(rows.groupBy(F.col(group).alias("_sw_group")).agg(F.approx_count_distinct(F.xxhash64(*ids)).alias("_sw_n")), "group-counts")
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts  # else a common group would be one task
    place = F.pmod(F.xxhash64(*ids), F.lit(1 << 32)) / float(1 << 32)
    near = rows.join(counts, rows[group] == counts["_sw_group"]).where(place * F.col("_sw_n") <= 4 * size).select(group, *ids).distinct()
    order = Window.partitionBy(group).orderBy(F.xxhash64(*ids), *ids)
    return near.withColumn("_sw_rank", F.row_number().over(order)).where(F.col("_sw_rank") <= size).drop("_sw_rank")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """A number by which the texts of one id are told apart; null counts as the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _maybe_named(docs: DataFrame, named: DataFrame, id_: str, key: str, value: str | None = None) -> tuple[Column, DataFrame, bool]:
    """Whether a row of ``docs`` can be among ``named``, that table, written, and whether it is few enough to broadcast.

    ``value``: an array column, whose parts count as well.
    """
    named = save(named, "named-rows")
    n, parts = named.agg(F.count("*"), F.sum(F.size(value)) if value else F.lit(0)).first()
    if n + (parts or 0) <= BROADCAST_ROWS:
        return F.lit(True), named, True
    bits = size_for(n)
    if bits is None:
        return F.lit(True), named, False
    held = bloom_filter(named, [id_, key], bits).scalar()
    return may_hold(held, [F.col("doc_id"), text_key(F.col("text"))], bits), named, False


def _same() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_sw_id")) & (text_key(F.col("text")) == F.col("_sw_key"))


def without(docs: DataFrame, named: DataFrame, id_: str, key: str) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text key) is not among ``named`` (id_, key; each once; null ids are equal).

    Up to ``BROADCAST_ROWS`` named rows are broadcast, so no text is shuffled. Beyond that a
    Bloom filter finds the rows that may be named, and only those go into a shuffle.
    """
    maybe, named, small = _maybe_named(docs, named, id_, key)
    named = named.select(F.col(id_).alias("_sw_id"), F.col(key).alias("_sw_key"))
    if small:
        return docs.join(F.broadcast(named), _same(), "left_anti")
    return docs.where(~maybe).unionByName(docs.where(maybe).join(named, _same(), "left_anti"))


def with_named(docs: DataFrame, named: DataFrame, id_: str, key: str, value: str) -> DataFrame:
    """``docs`` with the array column ``value`` of the row of ``named`` (id_, key, value) that names it, else null; see ``without``."""
    maybe, named, small = _maybe_named(docs, named, id_, key, value)
    named = named.select(F.col(id_).alias("_sw_id"), F.col(key).alias("_sw_key"), F.col(value).alias("_sw_value"))
    columns = [*[F.col(f"`{c}`") for c in docs.columns], F.col("_sw_value").alias(value)]
    if small:
        return docs.join(F.broadcast(named), _same(), "left").select(*columns)
    joined = docs.where(maybe).join(named, _same(), "left").select(*columns)
    return docs.where(~maybe).withColumn(value, F.lit(None).cast(joined.schema[value].dataType)).unionByName(joined)


def connected(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (u, v: bigint); component: its smallest node.

    Alternates large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond"): neighbours move to the smallest node
    seen, so the number of rounds grows with the logarithm of the size. Each
    round is written; a round that changes nothing ends it. Raises if the
    rounds run out, since a cut-off result would be wrong.
    """
    cur = save(edges.where("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct(), name)

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(cur)
    if not seen[0]:
        return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        # large star: every larger neighbour is tied to the smallest of the neighbourhood
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours are tied to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        cur = save(small.where("u <> v").distinct(), name)
        now = mark(cur)
        if now == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
    raise RuntimeError(f"{name}: components did not settle in {max_rounds} rounds")
