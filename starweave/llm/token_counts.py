"""Token counts as delta-maintained rollups with idempotent batch commits.

A store is a folder with two append-only Parquet tables. A batch of changes
(inserts, deletes, revised counts) becomes signed rows, is added up by source,
language and tokenizer version, and the sums are appended to `deltas` under a
fresh attempt id; one row in `commits` (batch id, attempt, checksum) then makes
the batch count. Totals are the sum of the deltas whose attempt is the committed
one of its batch. So a job that dies half-way leaves only rows that nobody reads,
a batch that is committed again changes nothing, and of two writers of one batch
exactly one counts. A batch id that comes back with other sums is refused.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.llm.common import save
from starweave.session import shared_path

KEYS = ("source", "lang", "tokenizer")
_DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch_id string, attempt string"
_COMMITS = "batch_id string, attempt string, checksum string"
WORDS, PIECES = "words-2", "pieces-1"


def signed(changes: DataFrame) -> DataFrame:
    """Changes (op, source, lang, tokenizer, n_tokens, old_tokens) as rows with signs.

    `insert` adds n_tokens, `delete` takes old_tokens away, `revise` replaces
    old_tokens by n_tokens. Null counts are 0. Any other op makes the job fail.
    """
    new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    op = F.col("op")
    docs = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null")))).cast("int"))
    tokens = F.when(op == "insert", new).when(op == "delete", -old).when(op == "revise", new - old)
    return changes.select(*KEYS, docs.cast("long").alias("n_docs"), tokens.cast("long").alias("n_tokens"))


class RollupStore:
    """The rollup in the folder ``path``, which all executors must see."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):  # anything else than a store without batches
                raise
            return self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        """The commit that counts of each batch: of several, the first by attempt id."""
        return self._read("commits", _COMMITS).groupBy("batch_id").agg(F.min_by("checksum", "attempt").alias("checksum"), F.min("attempt").alias("attempt"))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Commits a batch; False, and nothing changes, if it was committed before."""
        attempt = os.urandom(8).hex()
        sums = signed(changes).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums = sums.select("*", F.lit(batch_id).alias("batch_id"), F.lit(attempt).alias("attempt"))
        sums.write.mode("append").parquet(f"{self.path}/deltas")
        mine = self._read("deltas", _DELTAS).where((F.col("batch_id") == batch_id) & (F.col("attempt") == attempt))
        checksum = str(mine.agg(F.sum(F.xxhash64(*KEYS, "n_docs", "n_tokens").cast("decimal(38,0)"))).first()[0])
        before = self.commits().where(F.col("batch_id") == batch_id).first()
        if before is not None:
            if before["checksum"] != checksum:
                raise ValueError(f"batch {batch_id} was committed with other contents")
            return False
        row = self.spark.createDataFrame([(batch_id, attempt, checksum)], _COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return self.commits().where(F.col("batch_id") == batch_id).first()["attempt"] == attempt

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all committed batches; keys that no document is left of go."""
        counted = self._read("deltas", _DELTAS).join(self.commits().select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi")
        sums = counted.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def n_spaces(text: Column) -> Column:
    """The first, wrong count of words: one more than there are blanks."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")


def n_pieces(text: Column) -> Column:
    """Four bytes a token, rounded up."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4).cast("long")


def query(docs: DataFrame) -> DataFrame:
    """op4: totals after four batches of changes over all documents.

    1. every document arrives, its words counted by blanks; 2. every document is
    counted by a second tokenizer version; 3. the first counts are revised where
    counting real words gives another number; 4. the documents of each text are
    replaced by the one with the smallest id: all are deleted under both versions,
    that one is inserted again. Batches 2 and 4 are committed twice, as after a lost
    driver; that changes nothing. Null texts have no tokens; rows without an id sort first.
    """
    rows = docs.select("doc_id", "source", "lang", n_spaces(F.col("text")).alias("blanks"), n_words(F.col("text")).alias("words"), n_pieces(F.col("text")).alias("pieces"), F.sha2("text", 256).alias("digest"))
    rows = save(rows.withColumn("row", F.monotonically_increasing_id()), "token-counts")
    store = RollupStore(docs.sparkSession, shared_path(docs.sparkSession, "llm-rollup"))

    def change(df: DataFrame, op: str, tokenizer: str, new: str | None, old: str | None) -> DataFrame:
        count = lambda c: (F.col(c) if c else F.lit(None)).cast("long")
        return df.select(F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), count(new).alias("n_tokens"), count(old).alias("old_tokens"))

    # the first of each text by partial aggregation: a common text is no single task, and no join is needed
    texts = rows.where("digest is not null")
    first = texts.groupBy("digest").agg(F.min(F.struct("doc_id", "row", "source", "lang", "words", "pieces")).alias("f")).select("f.*")
    second = change(rows, "insert", PIECES, "pieces", None)
    last = change(texts, "delete", WORDS, None, "words").union(change(texts, "delete", PIECES, None, "pieces"))
    last = last.union(change(first, "insert", WORDS, "words", None)).union(change(first, "insert", PIECES, "pieces", None))
    store.commit("1-words", change(rows, "insert", WORDS, "blanks", None))
    for _ in range(2):
        store.commit("2-pieces", second)
    store.commit("3-recount", change(rows.where("blanks <> words"), "revise", WORDS, "words", "blanks"))
    for _ in range(2):
        store.commit("4-copies", last)
    return store.totals()
